"""Incremental ingest of newly arrived issue files."""
