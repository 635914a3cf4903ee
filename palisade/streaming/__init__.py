"""Structured Streaming forms of ingest, silver, deduplication and the hourly trend."""
