"""Structured Streaming jobs over arriving documents."""
