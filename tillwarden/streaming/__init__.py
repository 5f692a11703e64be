"""Structured Streaming paths."""
