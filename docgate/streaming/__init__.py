"""Structured Streaming sources and the stream job."""
