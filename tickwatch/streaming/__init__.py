"""Structured Streaming ingest and detection."""
