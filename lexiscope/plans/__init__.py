"""Whole plans: the weekly pipeline, and the registered queries."""
