"""Readers, cleaning and writers."""
