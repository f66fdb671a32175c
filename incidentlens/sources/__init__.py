"""Readers for landed incident records and exported files."""
