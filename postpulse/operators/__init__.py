"""Metrics, rankings, comparisons and predictions over post rows."""
