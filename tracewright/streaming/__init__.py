"""Structured Streaming form of the run-log monitoring."""
