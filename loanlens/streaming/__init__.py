"""Structured Streaming jobs."""

from loanlens.streaming.requests import (
    REQUEST_SCHEMA,
    read_request_stream,
    read_requests,
    score_requests_stream,
)

__all__ = ["REQUEST_SCHEMA", "read_request_stream", "read_requests", "score_requests_stream"]
