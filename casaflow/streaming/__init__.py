"""Incremental landing of newly arriving wide files (Structured Streaming)."""
