"""Structured Streaming queries: scoring and request metrics."""
