"""Structured Streaming forms of output validation and chunk assembly."""
