"""Structured Streaming: score repurchase requests as they arrive."""

from cartwise.streaming.scoring import REQUEST_SCHEMA, TIMED_REQUEST_SCHEMA, start_scoring_stream

__all__ = ["REQUEST_SCHEMA", "TIMED_REQUEST_SCHEMA", "start_scoring_stream"]
