"""Staging, marts, summaries and reports."""
