"""Structured Streaming: the row-wise decode over report files as they land."""

from stratus.streaming.landed import decode_stream, start_decode_stream  # noqa: F401
