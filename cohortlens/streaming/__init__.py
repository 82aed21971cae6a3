"""Structured Streaming entry points.

The reference processes finite files only; it has no stream, window,
watermark or state. What carries over is that every cleaning rule except
duplicate removal is row-local, so the same ``tag_transactions`` expression
runs unchanged on a file stream. Exact duplicate removal and everything
downstream (RFM, clustering, profiles) stay batch stages over the files the
stream writes.
"""

from cohortlens.streaming.clean_stream import (
    read_raw_stream,
    stream_audit_counts,
    stream_clean_rows,
)

__all__ = ["read_raw_stream", "stream_audit_counts", "stream_clean_rows"]
