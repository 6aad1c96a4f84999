"""Structured Streaming forms of the ingestion operators."""
