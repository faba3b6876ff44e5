"""Structured Streaming forms of scoring and stability monitoring."""
