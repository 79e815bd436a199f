"""Structured Streaming wiring and the stored tables it keeps."""
