"""Structured Streaming forms of ingestion, bars, quality and state."""
