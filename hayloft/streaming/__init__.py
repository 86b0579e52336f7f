"""Structured Streaming form of the bronze ingest (incremental, exactly-once)."""

from hayloft.streaming.ingest import ingest, ingest_bronze, read_message_stream, with_lineage  # noqa: F401
