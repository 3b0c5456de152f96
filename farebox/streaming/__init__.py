"""Structured Streaming entry to the incremental loads."""
