"""Structured Streaming forms of the periodic batch."""
