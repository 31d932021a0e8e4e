"""Incremental forms as Structured Streaming jobs."""
