"""Column-level functions."""
