"""Structured Streaming: incremental ingest of new quote documents."""
