"""Incremental ingestion of raw files with the same typing and rate operators."""

from churnlens.streaming.ingest import (
    latest_snapshot,
    raw_stream,
    running_rates,
    start_running_rates,
    start_typed_ingest,
)

__all__ = ["latest_snapshot", "raw_stream", "running_rates", "start_running_rates", "start_typed_ingest"]
