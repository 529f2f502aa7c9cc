"""Structured Streaming: new files to updated tables."""

from daybook.streaming.ingest import ingest_stream

__all__ = ["ingest_stream"]
