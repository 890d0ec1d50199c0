"""Structured Streaming jobs, changelog sinks and keyed state."""
