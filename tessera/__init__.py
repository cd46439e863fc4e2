"""Address matching, geocoding and corpus operators on Spark."""
