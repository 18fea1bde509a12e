"""Incremental ingest of newly landed documents."""
