"""Structured Streaming monitoring of pipeline events."""
