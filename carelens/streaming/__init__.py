"""Incremental ingest of claim files with Structured Streaming (see ingest.py)."""
