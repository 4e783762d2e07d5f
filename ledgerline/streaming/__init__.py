"""Structured Streaming jobs: tick ingest, dead-letter, dual sink, recent-N append, live rollups."""
