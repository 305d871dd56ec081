"""Staging, size checks and whole runs."""
