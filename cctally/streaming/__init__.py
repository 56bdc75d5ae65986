"""Incremental ingestion of landing folders (Structured Streaming)."""
