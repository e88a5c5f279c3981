"""Structured Streaming queries over the match stream."""
