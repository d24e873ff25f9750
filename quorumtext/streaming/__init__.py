"""Incremental ingestion and windowed counts with Structured Streaming."""
