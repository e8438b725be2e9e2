"""Structured Streaming form of the incremental landing."""
