"""The same rules over unbounded input, as Structured Streaming queries."""
