"""Queries over the given tables, and the SQL each result is checked against."""
