"""Structured Streaming form of the price ingest."""
