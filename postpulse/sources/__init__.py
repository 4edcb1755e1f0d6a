"""Where post rows, limit notices and stored baselines come from."""
