"""Structured Streaming jobs over the activity change stream."""
