"""Operators of a training-data pipeline: mixing, scoring, scans, deduplication, filters, formatting and output."""
