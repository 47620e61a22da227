"""DataFrame -> DataFrame transforms that work in batch and in Structured Streaming."""
