"""Structured Streaming operators over the cell log."""
