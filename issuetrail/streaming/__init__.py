"""Incremental runs over newly arrived archive files."""
