"""Whole jobs over a stored trade table."""
