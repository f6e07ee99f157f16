"""Structured Streaming jobs; each has its own checkpoint."""
