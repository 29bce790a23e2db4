"""Structured Streaming: incremental ingest of landed measurement payloads."""
