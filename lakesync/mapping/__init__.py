"""Landed JSON records (a ``payload`` column) to the typed rows of ``lakesync.schemas``."""
