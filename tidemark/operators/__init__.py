"""Operators: every function takes frames and returns a frame."""
