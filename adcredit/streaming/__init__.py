"""Structured Streaming jobs: dedup, ingest, freshness, daily windows, last touch."""
