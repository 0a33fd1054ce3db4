"""Structured Streaming: the triggered keyed sync from a change feed."""
