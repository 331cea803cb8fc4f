"""Column helpers."""
