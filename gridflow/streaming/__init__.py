"""Structured Streaming forms: sources, sinks and keyed-state operators."""
