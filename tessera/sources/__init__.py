"""Readers and writers beyond Spark's own: HTML tables, workbooks, shapefiles."""
