"""Incremental form of the daily load."""
