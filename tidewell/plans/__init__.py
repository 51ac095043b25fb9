"""Composite flows and the query catalogue."""
