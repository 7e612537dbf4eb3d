"""Raw device logs: stamping, routing, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_stream.functions import columns as C
from retail_stream.functions.records import evaluate_once


def _stamp_ms(raw: DataFrame) -> Column:
    """Arrival time when the source gives one (a replay then repeats it), else the clock."""
    if "arrival_ts" in raw.columns:
        return F.unix_millis("arrival_ts")
    return F.unix_millis(F.current_timestamp())


def stamped(raw: DataFrame) -> DataFrame:
    """Raw logs with ``stamped``, their text with the server time set, and ``stamp_ms``. ``stamped`` is
    null where a line holds no JSON object. Parsing happens once, for messages and rejects."""
    parsed = evaluate_once(raw, members=C.json_members("value"), stamp_ms=_stamp_ms(raw))
    return evaluate_once(parsed, stamped=C.stamped_json("members", F.col("stamp_ms"))).withColumn(
        "usable", F.col("members").isNotNull() & F.col("stamped").isNotNull()
    ).drop("members")


def messages(logs: DataFrame, prefix: str = "") -> DataFrame:
    """Of ``stamped`` logs: ``topic``, ``value``, ``log_date`` and, where present, ``arrival_ts``."""
    rest = [c for c in logs.columns if c == "arrival_ts"]
    return logs.filter("usable").select(
        C.log_topic("stamped", prefix).alias("topic"),
        F.col("stamped").alias("value"),
        C.log_date("stamp_ms").alias("log_date"),
        *rest,
    )


def rejects(logs: DataFrame) -> DataFrame:
    """Of ``stamped`` logs: the lines that hold no JSON object."""
    return logs.filter(~F.col("usable")).select("value", *[c for c in logs.columns if c == "arrival_ts"])


def route_logs(raw: DataFrame, prefix: str = "") -> DataFrame:
    """Stamp each log with its server time and name its topic."""
    return messages(stamped(raw), prefix)


def rejected_logs(raw: DataFrame) -> DataFrame:
    """Raw lines that hold no JSON object."""
    return rejects(stamped(raw))
