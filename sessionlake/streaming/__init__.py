"""Structured Streaming jobs for uploads and change files."""
