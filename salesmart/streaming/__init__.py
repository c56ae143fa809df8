"""Incremental ingestion: batch manifest and Structured Streaming."""
