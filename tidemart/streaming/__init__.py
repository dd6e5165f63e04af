"""Incremental file ingest and micro-batch maintenance of tables."""

from tidemart.streaming.ingest import ingest_files
from tidemart.streaming.tables import stream_snapshot, stream_upsert

__all__ = ["ingest_files", "stream_snapshot", "stream_upsert"]
