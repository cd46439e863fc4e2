"""Whole plans: geocoding pipelines and the query catalogue."""
