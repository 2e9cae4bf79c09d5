"""Structured Streaming: file ingest, stream reads of tables, stateful dedup, silver stream."""
