"""Structured Streaming: ingest, replay, dedup and bunching on streams."""
