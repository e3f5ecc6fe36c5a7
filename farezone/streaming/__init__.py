"""Incremental monthly refresh with Structured Streaming."""
