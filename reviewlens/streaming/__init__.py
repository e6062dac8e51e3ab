"""Structured Streaming forms of ingest, trend and upsert."""
