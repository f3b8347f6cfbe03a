"""Structured Streaming jobs: incremental file ingest, event counters and alerts."""
