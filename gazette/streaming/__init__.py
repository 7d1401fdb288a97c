"""Structured Streaming jobs: continuous refresh, change feed, file ingest."""
