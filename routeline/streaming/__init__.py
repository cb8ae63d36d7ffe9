"""Structured Streaming jobs: ingest, detection, status."""
