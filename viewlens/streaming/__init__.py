"""Structured Streaming jobs (incremental ingestion of the day files)."""
