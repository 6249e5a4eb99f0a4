"""Structured Streaming: incremental keep-first feed import."""

from feedworks.streaming.feed_stream import load_batch, start

__all__ = ["load_batch", "start"]
