"""Incident analytics on PySpark: see the README for the layout."""
