"""Structured Streaming jobs (incremental formatting of landed files)."""
