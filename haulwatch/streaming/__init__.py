"""Structured Streaming: keyed state, sinks, refreshed dimensions."""
