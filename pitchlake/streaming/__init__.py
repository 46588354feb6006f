"""Structured Streaming entry points."""

from pitchlake.streaming.ingest import event_stream, run_ingest, start_ingest  # noqa: F401
