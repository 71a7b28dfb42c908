"""Structured Streaming operators and query control."""
