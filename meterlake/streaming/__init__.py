"""Structured Streaming entry points for landed files."""
