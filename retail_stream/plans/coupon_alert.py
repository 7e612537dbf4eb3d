"""Coupon alerts of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from retail_stream.operators import alerts
from retail_stream.plans import records


def alerts_from_messages(
    raw: DataFrame,
    window: str = alerts.WINDOW,
    slide: str = alerts.SLIDE,
    min_accounts: int = alerts.MIN_ACCOUNTS,
) -> DataFrame:
    events = alerts.with_event_time(records.event_logs(raw))
    return alerts.coupon_alerts(events, window, slide, min_accounts)
