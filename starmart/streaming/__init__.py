"""Structured Streaming: monthly increments appended with keyed de-duplication."""

from starmart.streaming.increments import append_increments

__all__ = ["append_increments"]
