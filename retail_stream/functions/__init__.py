"""Column functions and row-wise DataFrame functions."""
