"""Structured Streaming: incremental scoring with exactly-once batch appends."""
