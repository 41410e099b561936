"""Structured Streaming: event enrichment, windowed counts, sinks.

The transformations take streaming and ordinary DataFrames alike.
"""
