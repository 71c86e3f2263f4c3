"""Reusable table operators and table checks."""
