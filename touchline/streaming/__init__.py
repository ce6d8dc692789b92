"""Ingest feeds on Structured Streaming."""
