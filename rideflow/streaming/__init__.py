"""Structured Streaming operators, sources and sinks."""
