"""Structured Streaming forms of the loads and status logs."""
