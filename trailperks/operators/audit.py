"""Run log: one row per executed step."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from trailperks import labels as L, schemas
from trailperks.params import small_table
from trailperks.sources.layers import Layers

RUN_LOG = "monitoring.pipeline_runs"
MESSAGE_LENGTH = 500


def log_step(
    layers: Layers, step: str, start: datetime, end: datetime, status: str, rows: int | None = None,
    message: str | None = None,
) -> None:
    text = message[:MESSAGE_LENGTH] if message else None
    entry = (uuid.uuid4().hex, step, start, end, status, rows, text)
    layers.append(RUN_LOG, small_table(layers.spark, [entry], schemas.PIPELINE_RUNS))


def logged_step(layers: Layers, step: str, work: Callable[[], int | None]) -> int | None:
    """Run one step and log its outcome; a failure is logged and raised again."""
    start = datetime.now(timezone.utc)
    try:
        rows = work()
    except Exception as problem:
        log_step(layers, step, start, datetime.now(timezone.utc), L.RUN_FAILED,
                 message=str(problem))
        raise
    log_step(layers, step, start, datetime.now(timezone.utc), L.RUN_OK, rows)
    return rows
