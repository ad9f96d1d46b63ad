"""Structured Streaming forms of the polling behaviour."""
