"""Streaming ingest of log text with Structured Streaming."""
