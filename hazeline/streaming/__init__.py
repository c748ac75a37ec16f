"""Structured Streaming forms of the ingest jobs."""
