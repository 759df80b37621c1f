"""Structured Streaming versions of the cleaning, window and scoring work."""
