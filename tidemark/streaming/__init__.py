"""Structured Streaming sink."""
