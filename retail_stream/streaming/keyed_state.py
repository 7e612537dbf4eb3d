"""State of single keys that the aggregating operators cannot keep. Needs the RocksDB state store, which
``session.configure`` sets."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues


class _FirstDay(StatefulProcessor):
    """The first day of a device. A key without news gives no row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._day = handle.getValueState("first_day", "day string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        day = min((row.log_date for row in rows), default=None)
        # Every call of the state is a message to the JVM, so it is asked once: None is an unknown device.
        known = self._day.get()
        if day is None or known is not None and known[0] <= day:
            return
        self._day.update((day,))
        yield Row(first_day=day, mid=key[0], present=True)
        if known is not None:
            yield Row(first_day=known[0], mid=key[0], present=False)

    def close(self) -> None:
        pass


def first_days(logs: DataFrame) -> DataFrame:
    """Where a device's first day becomes known or earlier: (first_day, mid, true), and (first_day, mid,
    false) for the day that is no longer its first.

    State is one day per device and has no end, as a device stays known. A micro-batch touches the state of
    the devices it mentions and no other; with a few rows each, plain rows cost less than a frame per device.
    """
    starts = logs.select("mid", "log_date").dropna()
    return starts.groupBy("mid").transformWithState(
        _FirstDay(), "first_day string, mid string, present boolean", "Update", "None"
    )


class _Held(StatefulProcessor):
    """The last value of a key, for a time from its last write on."""

    def __init__(self, milliseconds: int):
        self._keep = milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._value = handle.getValueState("value", "value string, until bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        value, until = self._value.get() if self._value.exists() else (None, None)
        frames = [f for f in rows]
        frame = pd.concat(frames).sort_values(["at", "write", "value"], kind="stable")
        out = []
        for at, write, text in zip(frame["at"], frame["write"], frame["value"]):
            live = until is not None and at <= until
            if write:
                value, until = text, max(at + self._keep, until or 0)
            else:
                out.append((key[0], text, at, value if live else None))
        if until is not None:
            for old in list(self._handle.listTimers()):
                self._handle.deleteTimer(old)
            self._value.update((value, until))
            self._handle.registerTimer(until)
        if out:
            yield pd.DataFrame(out, columns=["key", "probe", "asked", "value"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._value.clear()
        return iter([])

    def close(self) -> None:
        pass


def held_values(rows: DataFrame, seconds: int) -> DataFrame:
    """What a keyed value was when it was asked for: key, probe, asked (ms), value.

    ``rows`` are a stream of key, event_time (with a watermark), ``write`` and ``value``. A write holds for
    ``seconds`` after its time, bounds included; a later write of the key takes its place and prolongs it.
    Other rows are probes, with a text of their own in ``value``; they get the value held at their time, or
    null. At one time a probe comes before a write. State ends when the watermark passes its last moment.
    """
    timed = rows.selectExpr(
        "key", "event_time", "write", "value", "unix_millis(event_time) AS at"
    )
    return timed.groupBy("key").transformWithStateInPandas(
        _Held(seconds * 1000), "key string, probe string, asked bigint, value string", "Append", "EventTime"
    )
