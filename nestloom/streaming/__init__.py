"""Change feeds on Structured Streaming."""
