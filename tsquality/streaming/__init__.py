"""Structured Streaming: the per-meter stateful processor and the stream job."""
