"""Existing operators on Structured Streaming (no stream-only operators)."""

from .events import daily_purchase_stream, ingest_events  # noqa: F401
