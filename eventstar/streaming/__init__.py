"""Incremental ingestion of newly landed page files."""
