"""Coupon abuse: many accounts claiming coupons on one device in one sliding window, no item viewed."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_stream.functions import columns as C

# --- Fixed values ------------------------------------------------------------------------------
CLICK = "clickItem"
COUPON = "coupon"
WINDOW = "30 seconds"
SLIDE = "3 seconds"
MIN_ACCOUNTS = 3
# --- end of fixed values -----------------------------------------------------------------------

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    match = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", duration)
    if not match:
        raise ValueError(f"not a duration: {duration!r}")
    return int(match.group(1)) * _SECONDS[match.group(2)]


def with_event_time(logs: DataFrame) -> DataFrame:
    return logs.withColumn("event_time", C.event_time("ts"))


def _claimed() -> list[Column]:
    """Account and item of an event that claims a coupon, null for others."""
    claims = F.col("evid") == COUPON
    return [F.when(claims, F.col(c)).alias(a) for c, a in (("uid", "account"), ("itemid", "item"))]


def alert_sets() -> list[Column]:
    """What an alert says of its window, from events with account and item."""
    found = {"uids": "account", "itemIds": "item", "events": "evid"}
    return [F.sort_array(F.collect_set(c)).alias(a) for a, c in found.items()]


def with_claims(events: DataFrame) -> DataFrame:
    return events.select("*", *_claimed())


def alerting_windows(panes: DataFrame, length: int, step: int, pane: int, min_accounts: int) -> DataFrame:
    """mid, start: the windows, numbered by their start in steps, with enough accounts and no click. ``panes``
    has mid, pane, evid and account of every event; all times are whole seconds.

    An account adds one to the windows whose first pane with it a pane is: those that start after its pane
    before and no later than this one. A window's count is then a plain sum, which map tasks begin with, and
    no account is held beside another.
    """
    at = F.col("pane") * pane
    last = F.floor(at / step)
    clicked = F.col("evid") == CLICK
    marks = panes.filter(clicked | F.col("account").isNotNull()).select(
        "mid", "pane", "account", F.when(clicked, F.col("pane")).alias("click")
    ).distinct()
    # A click counts for itself: its pane before is none.
    before = F.lag("pane").over(Window.partitionBy("mid", "account", "click").orderBy("pane")) * pane
    first = F.floor(F.greatest(at - length, before) / step) + 1  # a null is no bound
    both = marks.select("mid", "pane", first.alias("first"), F.when(F.col("click").isNull(), 1).otherwise(0).alias("n"))
    starts = F.when(F.col("first") <= last, F.sequence("first", last))
    counted = both.select("mid", "n", F.explode(starts).alias("start")).groupBy("mid", "start").agg(
        F.sum("n").alias("accounts"), F.bool_or(F.col("n") == 0).alias("clicked")
    )
    return counted.filter((F.col("accounts") >= min_accounts) & ~F.col("clicked")).select("mid", "start")


def coupon_alerts(
    events: DataFrame,
    window: str = WINDOW,
    slide: str = SLIDE,
    min_accounts: int = MIN_ACCOUNTS,
) -> DataFrame:
    """Alerts from events that carry ``event_time``; key (mid, ts), ``ts`` the window's end in ms.

    Accounts are counted before any set is built. Events are reduced per device and pane first - the
    longest time step every window is made of - and the windows that alert are found by their counts alone.
    The events of their panes are then joined back, and sets made of those.
    """
    length, step = seconds(window), seconds(slide)
    pane = math.gcd(length, step)
    timed = with_claims(events.filter(F.col("event_time").isNotNull()))
    timed = timed.withColumn("pane", F.floor(F.unix_millis("event_time") / (pane * 1000)))
    distinct = timed.select("mid", "pane", "evid", "account", "item").distinct()
    hits = alerting_windows(timed, length, step, pane, min_accounts)
    first = F.floor(F.col("start") * step / pane)
    panes = F.explode(F.sequence(first, first + length // pane - 1))
    wanted = hits.select(F.col("mid").alias("of_mid"), "start", panes.alias("of_pane"))
    met = distinct.join(wanted, F.col("mid").eqNullSafe(F.col("of_mid")) & (F.col("pane") == F.col("of_pane")))
    end = (F.col("start") * step + length) * 1000
    found = met.groupBy("mid", "start").agg(*alert_sets())
    return found.select("mid", "uids", "itemIds", "events", end.cast("bigint").alias("ts"))
