"""The five jobs: collect, batch, live, compare, predict."""
