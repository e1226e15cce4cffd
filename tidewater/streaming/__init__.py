"""Structured Streaming sources, windowed aggregates and monitors."""
