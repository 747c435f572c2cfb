"""The same functions on Structured Streaming."""
