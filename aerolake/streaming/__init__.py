"""Incremental (exactly-once) loading with Structured Streaming."""
