"""Sync jobs: which rows to read, how to apply them, what to record."""
