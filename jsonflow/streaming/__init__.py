"""Sinks and streaming load jobs."""
