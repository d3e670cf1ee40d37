"""Structured Streaming forms of the weekly window."""
