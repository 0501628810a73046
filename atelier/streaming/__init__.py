"""Structured Streaming intake."""

from atelier.streaming.intake import stream_intake  # noqa: F401
