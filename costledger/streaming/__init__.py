"""Structured Streaming ingestion that reuses the batch operators."""
