"""Structured Streaming: micro-batch upserts into keyed lake tables."""

from tidemark.streaming.upsert_stream import file_stream, upsert_stream  # noqa: F401
