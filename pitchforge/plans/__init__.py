"""Composite plans: analogs, rating, star schema, analytics, resolution, ingest."""
