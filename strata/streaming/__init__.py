"""Structured Streaming variant of the raw -> Bronze step."""
