"""Structured Streaming: event parsing, ingest, deduplication, window statistics."""
