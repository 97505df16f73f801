"""Incremental checks driven by Structured Streaming (file source + foreachBatch)."""

from tideline.streaming.incremental import stream_checks

__all__ = ["stream_checks"]
