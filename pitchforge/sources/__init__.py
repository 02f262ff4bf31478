"""Scans, landing zones, nested documents, CSV, HTML and sinks."""

from pitchforge.sources import documents, files, html, landing, tables  # noqa: F401
