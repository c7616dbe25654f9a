"""Structured Streaming: files as they arrive, into the layers of the batch pipeline."""

from txlake.streaming.ingest import ingest_new_files, without_repeats

__all__ = ["ingest_new_files", "without_repeats"]
