"""Daily active devices of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from retail_stream.operators import dedup
from retail_stream.plans import records


def daily_active(raw: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """First start per day and device, without those already in ``seen``.

    Removing duplicates first sends one row per key to the anti join, which then reuses the
    partitioning of the first step.
    """
    first = dedup.first_starts(records.startup_logs(raw))
    return first if seen is None else dedup.drop_seen(first, seen)
