"""Structured Streaming entry points (stateless; foreachBatch sinks)."""
