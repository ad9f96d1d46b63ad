"""Scans, listings, catalogs, stores and sinks."""
