"""Structured Streaming sinks that reuse the batch operators."""

from framestore.streaming.upserts import upsert_stream

__all__ = ["upsert_stream"]
