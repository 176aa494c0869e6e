"""Incremental raw ingest with Structured Streaming (available-now runs)."""

from strata.streaming.incremental import clean_new_rows, ingest_new_files, raw_stream

__all__ = ["clean_new_rows", "ingest_new_files", "raw_stream"]
