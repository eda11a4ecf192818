"""Structured Streaming versions of the core measures."""
