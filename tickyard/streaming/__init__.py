"""Structured Streaming: sources, the deduplicated trade stream, sinks, waiting."""
