"""The streaming jobs. Each takes message streams and starts one query.

Progress and state live in ``checkpoint``; tables are written by batch number, so a job that is
stopped, killed or loses executors goes on from its checkpoint with the same results.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retail_stream import schemas
from retail_stream.functions import records as parsing
from retail_stream.operators import alerts, routing, sales
from retail_stream.plans import ingest, records
from retail_stream.sinks import files, tables, topics
from retail_stream.sources import topics as sources
from retail_stream.streaming import keyed_state, operators

Trigger = dict[str, Any]

# --- Fixed values: micro-batch intervals ---------------------------------------------------------
EVERY_5_SECONDS: Trigger = {"processingTime": "5 seconds"}
EVERY_3_SECONDS: Trigger = {"processingTime": "3 seconds"}
# --- end of fixed values -------------------------------------------------------------------------

# Notes of earlier batches that stay; a batch that is repeated is the last one.
NOTES_KEPT = 8
AVAILABLE_NOW: Trigger = {"availableNow": True}
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _start(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger,
    mode: str = "append",
) -> StreamingQuery:
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(write).start()


def batch_parts(query: StreamingQuery) -> list[dict[str, int]]:
    """What each micro-batch did and how long its parts took, from the progress reports Spark keeps of the
    query (``spark.sql.streaming.numRecentProgressUpdates``): ``batch``, ``rows``, ``late`` (rows left out),
    ``state_rows``, ``state_commit`` (of all tasks) and Spark's own parts, of which ``triggerExecution`` is
    the whole and ``addBatch`` the work; times in ms."""
    found = []
    for progress in query.recentProgress:
        state = progress["stateOperators"]
        found.append({
            "batch": progress["batchId"], "rows": progress["numInputRows"],
            "late": sum(s["numRowsDroppedByWatermark"] for s in state),
            "state_rows": sum(s["numRowsTotal"] for s in state),
            "state_commit": sum(s["commitTimeMs"] for s in state),
            **progress["durationMs"],
        })
    return found


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them and were left out, over the progress reports
    Spark keeps of the query (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def stream_ingest_logs(
    raw: DataFrame,
    topic_options: dict[str, str],
    archive_path: str,
    rejects_path: str,
    checkpoint: str,
    fmt: str = "kafka",
    prefix: str = "",
    trigger: Trigger = EVERY_3_SECONDS,
) -> StreamingQuery:
    """Raw logs to topics, daily archive and rejects."""

    def write(batch: DataFrame, batch_id: int) -> None:
        logs = routing.stamped(batch).persist()
        try:
            messages, n = routing.messages(logs, prefix), logs.count()
            topics.write_topics(messages, fmt, topic_options, batch_id, "logs", n)
            topics.archive_logs(messages, archive_path, batch_id, about=n)
            rejects = routing.rejects(logs).select(
                F.lit("logs").alias("topic"), "value", F.lit("malformed").alias("reason"), "arrival_ts"
            )
            tables.write_batch(rejects, tables.REJECTS, rejects_path, batch_id, fan=tables.FAN)
        finally:
            logs.unpersist()

    return _start(raw, write, checkpoint, trigger)


def stream_ingest_changes(
    raw: DataFrame,
    topic_options: dict[str, str],
    rejects_path: str,
    checkpoint: str,
    pattern: str = ".*",
    fmt: str = "kafka",
    prefix: str = "",
    trigger: Trigger = EVERY_3_SECONDS,
) -> StreamingQuery:
    """Database changes to topics, and messages that hold none to the rejects."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Envelopes are parsed once for topics and rejects.
        batch = sources.decoded_changes(batch).persist()
        try:
            changes = ingest.ingest_changes(batch, pattern, prefix)
            topics.write_topics(changes, fmt, topic_options, batch_id, "changes", batch.count())
            bad = sources.quarantine_changes(batch)
            tables.write_batch(bad, tables.REJECTS, rejects_path, batch_id, fan=tables.FAN)
        finally:
            batch.unpersist()

    return _start(raw, write, checkpoint, trigger)


def stream_rejects(
    raw: DataFrame,
    topic: schemas.Topic,
    path: str,
    checkpoint: str,
    trigger: Trigger = EVERY_3_SECONDS,
) -> StreamingQuery:
    """Messages of a topic that cannot be used, with the reason."""
    return _start(
        parsing.quarantine(raw, topic), tables.batch_writer(tables.REJECTS, path), checkpoint, trigger
    )


def stream_late_rows(
    raw: DataFrame,
    topic: schemas.Topic,
    path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    trigger: Trigger = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Messages whose event time lies more than ``delay`` before the latest of earlier micro-batches, to the
    rejects with the reason ``late``: what a stateful job with this delay may leave out of its results.

    The bound is the job's own. Each batch notes the latest event time up to it beside the table; the next
    one reads the note, and so does a batch that is repeated, which therefore splits alike.
    """
    spark = raw.sparkSession
    tables.create_table(spark, tables.REJECTS, path)
    wait = F.expr(f"INTERVAL {delay}")

    def note(batch_id: int) -> str:
        return f"{path}/_bounds/{batch_id}"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            text = files.read_text(spark, note(batch_id - 1))
            before = int(text) if text else None
            own = batch.agg(F.max(F.unix_micros("event_time"))).first()[0]
            bound = F.timestamp_micros(F.lit(before).cast("bigint")) - wait  # null before the first note
            late = batch.filter(F.col("event_time") < bound)
            rows = late.select(
                F.lit(topic.name).alias("topic"), "value", F.lit("late").alias("reason"), "arrival_ts"
            )
            tables.write_batch(rows, tables.REJECTS, path, batch_id, fan=tables.FAN)
            latest = max((t for t in (before, own) if t is not None), default="")
            files.write_text(spark, note(batch_id), str(latest), replace=True)
            files.remove(spark, note(batch_id - NOTES_KEPT))
        finally:
            batch.unpersist()

    return _start(parsing.with_event_time(raw, topic), write, checkpoint, trigger)


def stream_dau(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = EVERY_5_SECONDS,
    delay: str = "10 minutes",
    rows_per_file: int = tables.ROWS_PER_FILE,
) -> StreamingQuery:
    """Start messages to the table of daily active devices.

    Update mode gives every device that a batch mentions. Only those whose first start is new or
    earlier than stored are written, so the table grows with devices and not with starts. Stored rows are
    those of the batch's days; the commit log names their folders, and merging keeps these few. The batch's
    own rows are not looked at: a repeated batch writes the same rows again.
    """
    spark = raw.sparkSession
    tables.create_table(spark, tables.DAU, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            days = [r[0] for r in batch.select("log_date").distinct().collect() if r[0] is not None]
            stored = tables.read_rows(spark, tables.DAU, path, days=days).filter(F.col("batch_id") != batch_id)
            same = ["log_date", "mid", "ts", "uid"]
            known = stored.select(*[F.col(c).alias(f"s_{c}") for c in same])
            equal = reduce(and_, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in same])
            new = batch.join(known, equal, "left_anti")
            tables.write_batch(new, tables.DAU, path, batch_id, rows_per_file, tables.FAN)
        finally:
            batch.unpersist()

    first = operators.first_starts(records.startup_logs(raw), delay)
    return _start(first, write, checkpoint, trigger, "update")


def stream_first_days(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = EVERY_5_SECONDS,
    rows_per_file: int = tables.ROWS_PER_FILE,
) -> StreamingQuery:
    """Start messages to the table of first days. A batch writes devices that are new, or whose first day
    turns out to be earlier, whatever else it has."""
    tables.create_table(raw.sparkSession, tables.FIRST_DAYS, path)
    found = keyed_state.first_days(records.startup_logs(raw))
    return _start(found, tables.batch_writer(tables.FIRST_DAYS, path, rows_per_file), checkpoint, trigger, "update")


def stream_order_facts(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = EVERY_3_SECONDS,
    rows_per_file: int = tables.ROWS_PER_FILE,
) -> StreamingQuery:
    """Order messages to the order table."""
    return _start(
        records.orders(raw), tables.batch_writer(tables.ORDERS, path, rows_per_file), checkpoint, trigger
    )


def stream_users(
    raw: DataFrame, path: str, checkpoint: str, trigger: Trigger = EVERY_3_SECONDS
) -> StreamingQuery:
    """User messages to the user table the sale job looks users up in."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(sales.user_snapshot(batch), tables.USERS, path, batch_id, fan=tables.FAN)

    return _start(records.users(raw), write, checkpoint, trigger)


def stream_sale_detail(
    spark: SparkSession,
    raw_orders: DataFrame,
    raw_details: DataFrame,
    users_path: str,
    path: str,
    checkpoint: str,
    as_of: str | None = None,
    trigger: Trigger = EVERY_3_SECONDS,
    tolerance_seconds: int = sales.TOLERANCE_SECONDS,
    delay: str = "10 seconds",
    salts: int = 4,
    rows_per_file: int = tables.ROWS_PER_FILE,
) -> StreamingQuery:
    """Order and line messages to the sale table, with the user table as it is at each batch.

    Of repeated deliveries the table keeps the one the batch form keeps, whatever batch it came in.

    ``as_of`` is the day ages are counted to, by default the day of the batch.
    """
    pairs = operators.join_sales(
        records.orders(raw_orders), records.details(raw_details), tolerance_seconds, delay, salts
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        once = sales.one_sale_each(batch).persist()
        try:
            # A batch that only ends state has nothing to look up.
            if once.count():
                users = tables.lookup(spark, tables.USERS, users_path, once.select(F.col("user_id").alias("id")))
                day = F.current_date() if as_of is None else as_of
                rows = sales.enrich_users(once, users, day)
            else:
                rows = once.withColumns({"user_gender": nothing, "user_age": F.lit(0), "user_level": nothing})
            rows = sales.with_document_id(rows)
            tables.write_batch(rows, tables.SALES, path, batch_id, rows_per_file, tables.FAN)
        finally:
            once.unpersist()

    nothing = F.lit(None).cast("string")
    # An inner join gives nothing in a batch without messages; the next one with some ends the state as well.
    before = spark.conf.get(EMPTY_BATCHES)
    spark.conf.set(EMPTY_BATCHES, "false")
    try:
        return _start(pairs, write, checkpoint, trigger)
    finally:
        spark.conf.set(EMPTY_BATCHES, before)


def stream_coupon_alert(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = EVERY_3_SECONDS,
    delay: str = "10 seconds",
    window: str = alerts.WINDOW,
    slide: str = alerts.SLIDE,
    min_accounts: int = alerts.MIN_ACCOUNTS,
) -> StreamingQuery:
    """Event messages to the alert table.

    Append mode: an alert is written when its window has closed, since a click may still cancel it.
    """
    events = alerts.with_event_time(records.event_logs(raw)).withWatermark("event_time", delay)
    found = operators.coupon_alerts(events, window, slide, min_accounts)
    return _start(found, tables.batch_writer(tables.ALERTS, path), checkpoint, trigger)
