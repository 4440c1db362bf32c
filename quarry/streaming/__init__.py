"""Structured Streaming jobs over file sources with message columns."""
