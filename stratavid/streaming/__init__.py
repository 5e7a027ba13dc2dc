"""Structured Streaming loads: the daily polling jobs as streams over landed files."""
