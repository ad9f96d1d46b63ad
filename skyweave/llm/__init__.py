"""Operators of a training-data pipeline: scoring, near and exact copies, contamination, quality, tokens, chats, PII."""
