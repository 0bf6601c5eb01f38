"""Registered queries, each next to an independent DuckDB statement where SQL can express it."""
