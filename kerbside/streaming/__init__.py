"""Structured Streaming: the layer streams, late-data policies and strict event-time forms."""
