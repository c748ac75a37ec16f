"""Composed jobs: loading, reports, ingest."""
