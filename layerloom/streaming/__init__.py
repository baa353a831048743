"""Streaming jobs: change-log ingest with latest-row merge, and event-time windows."""
