"""Structured Streaming: alert queries, early-emission state, sinks, progress."""
