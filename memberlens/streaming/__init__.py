"""Structured Streaming jobs for database change events."""
