"""Incremental runs."""
