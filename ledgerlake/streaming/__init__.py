"""Incremental ingestion: skip dates already stored."""

from ledgerlake.streaming.incremental import (
    IngestResult,
    already_processed,
    ingest_new_dates,
    new_dates,
)

__all__ = ["IngestResult", "already_processed", "ingest_new_dates", "new_dates"]
