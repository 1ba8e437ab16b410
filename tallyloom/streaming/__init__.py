"""Incremental ingestion of releases."""
