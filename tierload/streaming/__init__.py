"""Structured Streaming form of the Bronze -> Silver load."""
