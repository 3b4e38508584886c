"""Structured Streaming forms of the day-bucketed reports."""
