"""Structured Streaming: queries, the per-batch data-quality sink, replays, progress."""
