"""Structured Streaming forms of the incremental build."""
