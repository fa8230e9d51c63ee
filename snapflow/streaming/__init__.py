"""Incremental ingestion of newly dropped files."""
