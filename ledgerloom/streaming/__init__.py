"""Incremental (available-now) file loads with Structured Streaming."""
