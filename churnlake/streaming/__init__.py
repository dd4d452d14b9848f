"""Processing of arriving files with Structured Streaming."""
