"""Structured Streaming variants of the batch statistics."""
