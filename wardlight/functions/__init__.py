"""Column helpers and SQL table functions."""
