"""Readers, data sources and writers."""
