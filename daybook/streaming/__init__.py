"""Structured Streaming versions of the daily feed."""
