"""Incremental delivery of the dashboard aggregates over arriving ride files."""
