"""Scans, sinks and projections of the given tables."""
