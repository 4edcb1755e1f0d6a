"""Structured Streaming: event time, sinks and state."""
