"""Readers for sensor files and messages, and scans over the stored tables."""
