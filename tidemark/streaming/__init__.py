"""Structured Streaming form of the chunked chart ingestion."""
