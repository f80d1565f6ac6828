"""Structured Streaming ingest and the incremental stages that follow it."""
