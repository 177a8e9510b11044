"""The realtime path as Structured Streaming queries."""
