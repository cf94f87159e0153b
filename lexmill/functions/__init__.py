"""Column to Column functions."""
