"""Structured Streaming scoring."""

from quarry.streaming.answers import answer_stream, publish  # noqa: F401
from quarry.streaming.score import score_stream  # noqa: F401
