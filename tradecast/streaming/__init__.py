"""Structured Streaming: the reference has no streams; its append load of raw
files is offered here as an incremental, checkpointed file-source stream."""

from tradecast.streaming.ingest import ingest_csv, ingest_role  # noqa: F401
