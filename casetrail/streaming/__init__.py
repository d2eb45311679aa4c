"""Structured Streaming path for the event feed."""
