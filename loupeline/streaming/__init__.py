"""Structured Streaming pipelines of the review loop."""
