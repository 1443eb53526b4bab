"""Incremental ingest (Structured Streaming)."""

from docloom.streaming.ingest import ingest_rejects, ingested, start_ingest  # noqa: F401
