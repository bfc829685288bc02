"""Incremental landing-log ingestion with Structured Streaming."""
