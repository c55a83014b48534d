"""Structured Streaming forms of the hourly and session operators."""
