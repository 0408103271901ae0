"""Structured Streaming jobs."""

from pairloom.streaming.jobs import (
    compact_stream_counts,
    encode_stream,
    merge_stream_counts,
    pretoken_counts_stream,
)

__all__ = ["compact_stream_counts", "encode_stream", "merge_stream_counts", "pretoken_counts_stream"]
