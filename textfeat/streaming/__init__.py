"""Incremental document frequency."""
