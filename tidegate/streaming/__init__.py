"""Structured Streaming versions of the event-ordered operators."""
