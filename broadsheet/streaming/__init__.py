"""Streaming jobs over queue messages."""
