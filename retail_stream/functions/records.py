"""JSON text to typed records and back, with a side output for unusable rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_stream.functions import columns as C
from retail_stream.schemas import Topic, full_name

CORRUPT = "_corrupt_record"


def evaluate_once(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns computed by a generator.

    Catalyst copies a plain projected expression into every filter pushed below it, so a JSON parse
    followed by a filter on three of its fields would run four times. It does not push filters
    through a generator on the generator's own output: the expression runs once per row.
    """
    made = F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()])))
    return df.select("*", made)


def _typed(name: str, kind: str) -> Column:
    if kind == "string":
        return F.col(name)
    if name == "ts":
        return C.epoch_ms(name).alias(name)
    return F.col(name).try_cast(kind).alias(name)


def _decode(raw: DataFrame, topic: Topic) -> DataFrame:
    """Parse ``value`` by field name. Every field is read as text first and then cast, so quoted
    numbers become numbers and unquoted numbers become text."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*topic.fields, CORRUPT)])
    kept = ["value", *[c for c in raw.columns if c == "arrival_ts"]]
    parsed = raw.select(*kept, F.inline(F.array(F.from_json("value", text))))
    return parsed.select(*kept, *[_typed(n, t) for n, t in topic.payload], CORRUPT)


def _usable(topic: Topic) -> Column:
    present = [F.col(n).isNotNull() for n in topic.required]
    return reduce(lambda a, b: a & b, present, F.col(CORRUPT).isNull())


def parse(raw: DataFrame, topic: Topic) -> DataFrame:
    """Rows of ``raw`` (``value`` text, maybe ``arrival_ts``) that parse and carry their key."""
    return _decode(raw, topic).filter(_usable(topic)).drop("value", CORRUPT)


def with_event_time(raw: DataFrame, topic: Topic) -> DataFrame:
    """``value``, maybe ``arrival_ts``, and the ``event_time`` of messages that can be used and have a ``ts``."""
    rows = _decode(raw, topic).filter(_usable(topic) & F.col("ts").isNotNull())
    rest = [c for c in raw.columns if c == "arrival_ts"]
    return rows.select("value", *rest, C.event_time("ts").alias("event_time"))


def quarantine(raw: DataFrame, topic: Topic) -> DataFrame:
    """The rows ``parse`` leaves out: ``topic``, ``value``, ``reason`` and maybe ``arrival_ts``."""
    decoded = _decode(raw, topic).filter(~_usable(topic))
    nothing = F.col("value").isNull() | (F.trim("value") == "") | F.col(CORRUPT).isNotNull()
    ranged = F.lit(False)
    if "ts" in topic.required:
        # A number that is there, but lies outside the years that can be printed.
        given = F.get_json_object("value", "$.ts").try_cast("bigint")
        ranged = F.col("ts").isNull() & given.isNotNull()
    reason = (
        F.when(nothing, F.lit("malformed")).when(ranged, F.lit("ts out of range")).otherwise(F.lit("missing key"))
    )
    rest = [c for c in raw.columns if c == "arrival_ts"]
    return decoded.select(
        F.lit(topic.name).alias("topic"), "value", reason.alias("reason"), *rest
    )


def to_messages(records: DataFrame, topic: Topic, prefix: str = "") -> DataFrame:
    """Records as messages: ``topic``, ``value`` (JSON of the payload) and maybe ``arrival_ts``."""
    rest = [c for c in records.columns if c == "arrival_ts"]
    fields = [f for f in topic.fields if f in records.columns]
    return records.select(
        F.lit(full_name(topic, prefix)).alias("topic"),
        F.to_json(F.struct(*fields)).alias("value"),
        *rest,
    )


def with_log_time(logs: DataFrame) -> DataFrame:
    """Add ``log_date`` and ``log_hour`` from ``ts``."""
    return logs.withColumns({"log_date": C.log_date("ts"), "log_hour": C.log_hour("ts")})


def with_create_time(orders: DataFrame) -> DataFrame:
    """Add ``create_date`` and ``create_hour`` from ``create_time``."""
    return orders.withColumns(
        {"create_date": C.create_date("create_time"), "create_hour": C.create_hour("create_time")}
    )
