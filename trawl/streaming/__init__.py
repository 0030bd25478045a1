"""Incremental (Structured Streaming) jobs."""
