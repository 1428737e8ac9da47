"""Incremental loads and scoring with Structured Streaming."""
