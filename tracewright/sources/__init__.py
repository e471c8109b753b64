"""Scans, input adapters and sinks."""
