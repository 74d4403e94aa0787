"""Structured Streaming jobs (incremental feature maintenance)."""
