"""Geocoding of rows as they arrive."""
