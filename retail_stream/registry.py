"""Every query by name: (spark, folder with the given tables) -> DataFrame.

All run over the whole tables. Arrays and maps come back as sorted text so that results compare by
value; dates are parameters, never the clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_stream import schemas, session
from retail_stream.functions import columns as C
from retail_stream.functions import records
from retail_stream.operators import alerts, cdc, counts, dedup, routing, sales
from retail_stream.plans import dashboard, ingest
from retail_stream.plans import records as record_plans
from retail_stream.plans.coupon_alert import alerts_from_messages
from retail_stream.plans.dau import daily_active
from retail_stream.plans.sale_detail import sale_details
from retail_stream.scratch import scratch_dir
from retail_stream.sinks import tables, topics
from retail_stream.sources import testdata as given
from retail_stream.sources import topics as sources
from retail_stream.streaming import jobs, keyed_state, operators
from retail_stream.streaming.replay import arrival_bounds, replay

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-15"
BATCH_CUT_MS = 1705320000000  # 2024-01-15 12:00 UTC
ALERT_WINDOW = "2 hours"
ALERT_SLIDE = "30 minutes"
HARD_PARTS = 5  # micro-batches of the replays with repeated, broken or shifted messages
# Messages in a micro-batch of a replay, and orders where lines come with them, before there are more of them.
MOST_MESSAGES = 8_000_000
MOST_ORDERS = 1_500_000
# Lines of the sale table that are joined at a time.
SLICE_LINES = 20_000_000
FEBRUARY_2024_MS = 1706745600000
FAR_AHEAD_MS = 4102444800000  # 2100-01-01 UTC

_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its function name. The tables' times are UTC wall-clock times."""

    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)

    _QUERIES[run.__name__] = in_utc
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _messages(rows: DataFrame, topic: schemas.Topic) -> DataFrame:
    return records.to_messages(rows, topic)


def _text(alert_rows: DataFrame) -> DataFrame:
    lists = {n: F.array_join(F.sort_array(n), ",") for n in ("uids", "itemIds", "events")}
    return alert_rows.select(*schemas.ALERT_COLUMNS).withColumns(lists)


# --- records ---------------------------------------------------------------------------------


@query
def parse_startup(spark, sf_dir):
    raw = _messages(given.startup_payload(spark, sf_dir), schemas.STARTUP)
    return record_plans.startup_logs(raw).drop("arrival_ts")


@query
def parse_event(spark, sf_dir):
    raw = _messages(given.event_payload(spark, sf_dir), schemas.EVENT)
    return record_plans.event_logs(raw).drop("arrival_ts")


@query
def parse_order(spark, sf_dir):
    raw = _messages(given.order_payload(spark, sf_dir), schemas.ORDER)
    return records.with_create_time(records.parse(raw, schemas.ORDER)).drop("arrival_ts")


@query
def parse_detail(spark, sf_dir):
    raw = _messages(given.details(spark, sf_dir), schemas.DETAIL)
    return record_plans.details(raw).drop("arrival_ts")


@query
def parse_user(spark, sf_dir):
    raw = _messages(given.users(spark, sf_dir), schemas.USER)
    return record_plans.users(raw).drop("arrival_ts")


@query
def record_to_json(spark, sf_dir):
    return _messages(given.users(spark, sf_dir), schemas.USER).select("topic", "value")


@query
def bad_rows(spark, sf_dir):
    bad = records.quarantine(given.damaged_logs(spark, sf_dir), schemas.EVENT)
    return bad.select("topic", "value", "reason")


@query
def good_rows(spark, sf_dir):
    return records.parse(given.damaged_logs(spark, sf_dir), schemas.EVENT).drop("arrival_ts")


@query
def mask_phone(spark, sf_dir):
    return given.order_payload(spark, sf_dir).select(
        "id", C.mask_phone("consignee_tel").alias("consignee_tel")
    )


@query
def order_facts(spark, sf_dir):
    raw = _messages(given.order_payload(spark, sf_dir), schemas.ORDER)
    return record_plans.orders(raw).drop("arrival_ts")


# --- intake ----------------------------------------------------------------------------------


@query
def stamp_and_route_logs(spark, sf_dir):
    raw = given.raw_logs(spark, sf_dir).select("value", "arrival_ts")
    return routing.route_logs(raw).select("topic", "value", "log_date")


@query
def rejected_logs(spark, sf_dir):
    raw = given.damaged_logs(spark, sf_dir)
    return ingest.ingest_logs(raw).rejects.select(C.log_topic("value").alias("topic"), "value")


@query
def cdc_route(spark, sf_dir):
    return cdc.route_changes(given.changes(spark, sf_dir)).select("topic", "value")


CHANGE_PATTERN = r"shop\.(order|user)_.*"


def _change_messages(spark, sf_dir) -> DataFrame:
    fields = [f.name for f in schemas.CHANGE_ENVELOPE.fields]
    envelopes = given.changes(spark, sf_dir)
    return envelopes.select(
        F.lit("changes").alias("topic"), F.to_json(F.struct(*fields)).alias("value"), "arrival_ts"
    )


def _broken_changes(spark, sf_dir) -> DataFrame:
    """One broken envelope per order, of four kinds."""
    orders = given.table(spark, sf_dir, "orders")
    kind, key = F.col("o_orderkey") % 4, F.col("o_orderkey").cast("string")
    value = (
        F.when(kind == 0, F.concat(F.lit("oops "), key))
        .when(kind == 1, F.concat(F.lit('{"entry_type":"ROWDATA","table_name":"'), key))
        .when(kind == 2, F.concat(F.lit('{"table_name":"'), key, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"entry_type":"ROWDATA","table_name":"'), key, F.lit('"}')))
    )
    at = F.col("o_orderdate").cast("timestamp").alias("arrival_ts")
    return orders.select(F.lit("changes").alias("topic"), value.alias("value"), at)


@query
def cdc_intake(spark, sf_dir):
    raw = _change_messages(spark, sf_dir).drop("topic")
    return ingest.ingest_changes(raw, CHANGE_PATTERN).select("topic", "value")


@query
def bad_changes(spark, sf_dir):
    """Broken envelopes among good ones: the value and what is wrong with it."""
    raw = _change_messages(spark, sf_dir).unionByName(_broken_changes(spark, sf_dir)).drop("topic")
    return sources.quarantine_changes(raw).select("value", "reason")


@query
def topic_files(spark, sf_dir):
    path = scratch_dir(spark, "topics")
    raw = given.raw_logs(spark, sf_dir).select("value", "arrival_ts")
    topics.write_topics(routing.route_logs(raw), "json", {"path": path})
    starts = sources.read_topic(spark, schemas.STARTUP, "json", {"path": path}, streaming=False)
    events = sources.read_topic(spark, schemas.EVENT, "json", {"path": path}, streaming=False)
    return record_plans.startup_logs(starts).select("type", "mid", "ts").unionByName(
        record_plans.event_logs(events).select("type", "mid", "ts")
    )


@query
def log_archive(spark, sf_dir):
    path = scratch_dir(spark, "archive")
    raw = given.raw_logs(spark, sf_dir).select("value", "arrival_ts")
    topics.archive_logs(routing.route_logs(raw), path)
    return topics.read_archive(spark, path)


# --- daily active devices --------------------------------------------------------------------


def _dau(spark, sf_dir) -> DataFrame:
    return dedup.first_starts(given.startup_logs(spark, sf_dir))


@query
def dau_first_start(spark, sf_dir):
    return _dau(spark, sf_dir)


@query
def dau_from_messages(spark, sf_dir):
    return daily_active(_messages(given.startup_payload(spark, sf_dir), schemas.STARTUP))


@query
def dau_top_n_starts(spark, sf_dir):
    return dedup.first_starts(given.startup_logs(spark, sf_dir), 3)


@query
def dau_cross_batch(spark, sf_dir):
    logs = given.startup_logs(spark, sf_dir)
    stored = dedup.first_starts(logs.filter(F.col("ts") < BATCH_CUT_MS))
    new = dedup.first_starts(logs.filter(F.col("ts") >= BATCH_CUT_MS))
    return stored.unionByName(dedup.drop_seen(new, stored))


@query
def dau_table(spark, sf_dir):
    path = scratch_dir(spark, "dau")
    tables.write_table(_dau(spark, sf_dir), tables.DAU, path)
    return tables.read_table(spark, tables.DAU, path)


@query
def dau_total(spark, sf_dir):
    return counts.dau_total(_dau(spark, sf_dir), DAY)


@query
def dau_hourly(spark, sf_dir):
    return counts.dau_hourly(_dau(spark, sf_dir), DAY)


@query
def dau_hourly_all_days(spark, sf_dir):
    active = daily_active(_messages(given.startup_payload(spark, sf_dir), schemas.STARTUP))
    return active.groupBy("log_date", "log_hour").agg(F.count("*").alias("ct"))


@query
def dau_hour_map(spark, sf_dir):
    hours = F.map_entries("hours")
    text = F.transform(hours, lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return counts.dau_hour_map(_dau(spark, sf_dir), DAY).select(F.array_join(text, ",").alias("hours"))


@query
def new_devices(spark, sf_dir):
    return counts.new_devices(_dau(spark, sf_dir), DAY)


@query
def realtime_total(spark, sf_dir):
    return counts.realtime_total(_dau(spark, sf_dir), DAY)


@query
def hours_today_yesterday(spark, sf_dir):
    return counts.hours_today_yesterday(_dau(spark, sf_dir), DAY)


@query
def realtime_hours(spark, sf_dir):
    return counts.realtime_hours(_dau(spark, sf_dir), "dau", DAY)


# --- sales -----------------------------------------------------------------------------------


@query
def order_detail_full_outer(spark, sf_dir):
    return sales.full_outer(given.orders(spark, sf_dir), given.details(spark, sf_dir))


@query
def sale_interval_join(spark, sf_dir):
    return sales.join_sales(given.orders(spark, sf_dir), given.details(spark, sf_dir))


@query
def unmatched_details(spark, sf_dir):
    rows = sales.unmatched_details(given.orders(spark, sf_dir), given.details(spark, sf_dir))
    return rows.drop("detail_arrival")


@query
def unmatched_orders(spark, sf_dir):
    rows = sales.unmatched_orders(given.orders(spark, sf_dir), given.details(spark, sf_dir))
    return rows.drop("order_arrival")


@query
def user_snapshot(spark, sf_dir):
    return sales.user_snapshot(given.users(spark, sf_dir)).drop("arrival_ts")


@query
def sale_detail(spark, sf_dir):
    return sale_details(
        given.orders(spark, sf_dir), given.details(spark, sf_dir), given.users(spark, sf_dir), given.AS_OF
    )


@query
def first_sales(spark, sf_dir):
    return sale_detail(spark, sf_dir).orderBy("doc_id").limit(100)


@query
def order_table(spark, sf_dir):
    path = scratch_dir(spark, "orders")
    raw = _messages(given.order_payload(spark, sf_dir), schemas.ORDER)
    tables.write_table(record_plans.orders(raw), tables.ORDERS, path)
    return tables.read_table(spark, tables.ORDERS, path).drop("arrival_ts")


REPEATED_DAY = "1995-06-15"


def _repeated_orders(spark, sf_dir) -> str:
    """A table of orders of which a third was delivered again 100 s later, half of them in the same
    batch, with another status, and a third of those with a day three days on."""
    path = scratch_dir(spark, "orders-repeats")
    first = given.order_payload(spark, sf_dir)
    key = F.col("id").cast("bigint")
    moved = F.date_format(
        F.to_timestamp("create_time") + F.expr("INTERVAL 3 DAYS"), "yyyy-MM-dd HH:mm:ss"
    )
    again = first.filter(key % 3 == 0).withColumns({
        "order_status": F.lit("A again"),
        "create_time": F.when(key % 9 == 0, moved).otherwise(F.col("create_time")),
        "arrival_ts": F.col("arrival_ts") + F.expr("INTERVAL 100 SECONDS"),
    })
    batches = (first.unionByName(again.filter(key % 6 == 0)), again.filter(key % 6 == 3))
    for number, batch in enumerate(batches):
        rows = record_plans.orders(_messages(batch, schemas.ORDER))
        tables.write_batch(rows, tables.ORDERS, path, number)
    return path


@query
def order_table_repeats(spark, sf_dir):
    return tables.read_table(spark, tables.ORDERS, _repeated_orders(spark, sf_dir)).drop("arrival_ts")


@query
def order_table_day(spark, sf_dir):
    path = _repeated_orders(spark, sf_dir)
    return tables.read_table(spark, tables.ORDERS, path, days=[REPEATED_DAY]).drop("arrival_ts")


@query
def sale_table(spark, sf_dir):
    path = scratch_dir(spark, "sales")
    found = sale_details(
        given.orders(spark, sf_dir), given.details(spark, sf_dir), given.users(spark, sf_dir), given.AS_OF,
        arrivals=True,
    )
    slices = max(1, -(-given.table(spark, sf_dir, "lineitem").count() // SLICE_LINES))
    tables.write_table(found, tables.SALES, path, slices=slices)
    return tables.read_table(spark, tables.SALES, path).drop(*sales.ARRIVALS)


# --- alerts ----------------------------------------------------------------------------------


@query
def coupon_alert(spark, sf_dir):
    events = given.event_logs(spark, sf_dir)
    return _text(alerts.coupon_alerts(events, ALERT_WINDOW, ALERT_SLIDE))


@query
def coupon_alert_messages(spark, sf_dir):
    raw = _messages(given.event_payload(spark, sf_dir), schemas.EVENT)
    return _text(alerts_from_messages(raw, ALERT_WINDOW, ALERT_SLIDE))


@query
def alert_table(spark, sf_dir):
    path = scratch_dir(spark, "alerts")
    found = alerts.coupon_alerts(given.event_logs(spark, sf_dir), ALERT_WINDOW, ALERT_SLIDE)
    tables.write_table(found, tables.ALERTS, path)
    return _text(tables.read_table(spark, tables.ALERTS, path))


# --- streams, replayed to their final state --------------------------------------------------


def _json(path: str) -> dict[str, str]:
    return {"path": f"{path}/topics"}


@query
def stream_ingest_logs(spark, sf_dir):
    """Raw logs through the intake job; its start topic then feeds the daily active devices."""
    path = scratch_dir(spark, "stream-ingest")
    raw = given.raw_logs(spark, sf_dir).select(
        F.lit("logs").alias("topic"), "value", "arrival_ts"
    )

    def start():
        logs = sources.read_messages(spark, "logs", "json", {"path": f"{path}/raw"})
        return jobs.stream_ingest_logs(
            logs, _json(path), f"{path}/archive", f"{path}/rejects", f"{path}/checkpoint",
            fmt="json", trigger=jobs.AVAILABLE_NOW,
        )

    replay(raw, f"{path}/raw", start)
    starts = sources.read_topic(spark, schemas.STARTUP, "json", _json(path), streaming=False)
    return daily_active(starts)


@query
def stream_ingest_outputs(spark, sf_dir):
    """All that the intake job leaves, raw and broken lines together: both topics, the archive, the rejects."""
    path = scratch_dir(spark, "stream-ingest-all")
    raw = given.raw_logs(spark, sf_dir).select("value", "arrival_ts")
    broken = given.damaged_logs(spark, sf_dir).filter(~F.endswith("value", F.lit("}"))).select("value", "arrival_ts")
    messages = raw.unionByName(broken).select(F.lit("logs").alias("topic"), "value", "arrival_ts")

    def start():
        logs = sources.read_messages(spark, "logs", "json", {"path": f"{path}/raw"})
        return jobs.stream_ingest_logs(
            logs, _json(path), f"{path}/archive", f"{path}/rejects", f"{path}/checkpoint",
            fmt="json", trigger=jobs.AVAILABLE_NOW,
        )

    replay(messages, f"{path}/raw", start, bounds=arrival_bounds(messages, HARD_PARTS, MOST_MESSAGES))
    found = [
        sources.read_topic(spark, t, "json", _json(path), streaming=False).select(F.lit(t.name).alias("output"), "value")
        for t in (schemas.STARTUP, schemas.EVENT)
    ]
    archive = topics.read_archive(spark, f"{path}/archive")
    found.append(archive.select(F.concat(F.lit("archive "), "log_date").alias("output"), "value"))
    rejects = tables.read_table(spark, tables.REJECTS, f"{path}/rejects")
    found.append(rejects.select(F.concat_ws(" ", F.lit("rejects"), "topic", "reason").alias("output"), "value"))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query
def raw_text_intake(spark, sf_dir):
    """Logs as lines of text files, stamped with the time their file arrived, and routed. That time differs
    from run to run; all else is compared."""
    path = scratch_dir(spark, "raw-lines")
    given.raw_logs(spark, sf_dir).select("value").write.text(path)
    found = routing.route_logs(sources.read_raw_logs(spark, path))
    field = lambda name: F.get_json_object("value", f"$.{name}")
    same_day = F.col("log_date") == C.log_date(field("ts").cast("bigint"))
    return found.select(
        "topic", *[field(n).alias(n) for n in ("mid", "uid", "type", "area")],
        (same_day & (field("ts").cast("bigint") > FEBRUARY_2024_MS)).alias("stamped"),
    )


@query
def stream_ingest_changes(spark, sf_dir):
    """Changes, broken ones among them, through the intake job: what is on the topics."""
    path = scratch_dir(spark, "stream-changes")
    raw = _change_messages(spark, sf_dir).unionByName(_broken_changes(spark, sf_dir))

    def start():
        changes = sources.read_messages(spark, "changes", "json", {"path": f"{path}/raw"})
        return jobs.stream_ingest_changes(
            changes, _json(path), f"{path}/rejects", f"{path}/checkpoint", CHANGE_PATTERN, fmt="json",
            trigger=jobs.AVAILABLE_NOW,
        )

    replay(raw, f"{path}/raw", start, bounds=arrival_bounds(raw, HARD_PARTS, MOST_MESSAGES), forget=True)
    read = [
        sources.read_topic(spark, t, "json", _json(path), streaming=False).select(F.lit(t.name).alias("topic"), "value")
        for t in (schemas.ORDER, schemas.DETAIL, schemas.USER)
    ]
    return read[0].unionByName(read[1]).unionByName(read[2])


def _dau_by_stream(spark, sf_dir, parts: int) -> str:
    path = scratch_dir(spark, "stream-dau")
    messages = _messages(given.startup_payload(spark, sf_dir), schemas.STARTUP)

    def start():
        raw = sources.read_topic(spark, schemas.STARTUP, "json", _json(path))
        return jobs.stream_dau(raw, f"{path}/dau", f"{path}/checkpoint", jobs.AVAILABLE_NOW)

    replay(messages, f"{path}/topics", start, parts)
    return f"{path}/dau"


@query
def stream_dau(spark, sf_dir):
    return tables.read_table(spark, tables.DAU, _dau_by_stream(spark, sf_dir, 2))


@query
def stream_dau_zone(spark, sf_dir):
    """Every stored row of the job, days and hours of a zone eight hours ahead."""
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        path = _dau_by_stream(spark, sf_dir, HARD_PARTS)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return tables.read_table(spark, tables.DAU, path)


ROCKSDB = "spark.sql.streaming.stateStore.providerClass"


def _first_days_by_stream(spark, sf_dir, messages: DataFrame | None = None) -> str:
    path = scratch_dir(spark, "stream-first-days")
    if messages is None:
        messages = _messages(given.startup_payload(spark, sf_dir), schemas.STARTUP)
    before = spark.conf.get(ROCKSDB, None)
    spark.conf.set(ROCKSDB, session.SETTINGS[ROCKSDB])

    def start():
        raw = sources.read_topic(spark, schemas.STARTUP, "json", _json(path))
        return jobs.stream_first_days(raw, f"{path}/first", f"{path}/checkpoint", jobs.AVAILABLE_NOW)

    try:
        replay(messages, f"{path}/topics", start, HARD_PARTS)
    finally:
        spark.conf.unset(ROCKSDB) if before is None else spark.conf.set(ROCKSDB, before)
    return f"{path}/first"


@query
def stored_realtime_total(spark, sf_dir):
    active = _dau_by_stream(spark, sf_dir, 2)
    return dashboard.realtime_total(spark, active, _first_days_by_stream(spark, sf_dir), DAY)


@query
def stored_new_devices(spark, sf_dir):
    return dashboard.new_devices(spark, _first_days_by_stream(spark, sf_dir), DAY)


@query
def stored_first_days(spark, sf_dir):
    """New devices of every day, from messages delivered out of order: later days of a device are known
    before earlier ones."""
    payload = given.startup_payload(spark, sf_dir)
    shuffled = F.timestamp_seconds(F.pmod(F.xxhash64("mid", "ts", "uid"), F.lit(1_000_000)))
    messages = _messages(payload.withColumn("arrival_ts", shuffled), schemas.STARTUP)
    rows = tables.read_table(spark, tables.FIRST_DAYS, _first_days_by_stream(spark, sf_dir, messages))
    return rows.filter("present").groupBy("first_day").agg(F.count("*").alias("new_mids"))


@query
def stream_late_rows(spark, sf_dir):
    """A seventh of the devices reports six days late; late is what lies a day or more behind."""
    path = scratch_dir(spark, "stream-late")
    slow = F.pmod(F.col("uid").cast("bigint"), F.lit(7)) == 0
    arrival = F.timestamp_millis("ts") + F.when(slow, F.expr("INTERVAL 6 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    payload = given.startup_payload(spark, sf_dir).withColumn("arrival_ts", arrival)

    def start():
        raw = sources.read_topic(spark, schemas.STARTUP, "json", _json(path))
        return jobs.stream_late_rows(
            raw, schemas.STARTUP, f"{path}/late", f"{path}/checkpoint", "1 DAY", jobs.AVAILABLE_NOW
        )

    replay(_messages(payload, schemas.STARTUP), f"{path}/topics", start, HARD_PARTS)
    rows = tables.read_table(spark, tables.REJECTS, f"{path}/late")
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return rows.select("topic", "reason", field("mid").alias("mid"), field("uid").alias("uid"), field("ts").cast("bigint").alias("ts"))


HOLD_SECONDS = 3 * 86400


@query
def stream_held_values(spark, sf_dir):
    """For every click, the item of the last coupon on the device, if that was at most three days ago. Every
    coupon of a device prolongs its state."""
    path = scratch_dir(spark, "stream-held")
    messages = _messages(given.event_payload(spark, sf_dir), schemas.EVENT)
    before = spark.conf.get(ROCKSDB, None)
    spark.conf.set(ROCKSDB, session.SETTINGS[ROCKSDB])

    def start():
        raw = sources.read_topic(spark, schemas.EVENT, "json", _json(path))
        logs = alerts.with_event_time(record_plans.event_logs(raw)).withWatermark("event_time", "1 minute")
        write = F.col("evid") == alerts.COUPON
        rows = logs.filter(F.col("evid").isin(alerts.COUPON, alerts.CLICK)).select(
            F.col("mid").alias("key"), "event_time", write.alias("write"),
            F.when(write, F.col("itemid")).otherwise(F.concat_ws("-", "uid", "pgid")).alias("value"),
        )
        held = keyed_state.held_values(rows, HOLD_SECONDS)
        writer = held.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint")
        return writer.trigger(**jobs.AVAILABLE_NOW).format("parquet").start(f"{path}/out")

    try:
        replay(messages, f"{path}/topics", start, HARD_PARTS)
    finally:
        spark.conf.unset(ROCKSDB) if before is None else spark.conf.set(ROCKSDB, before)
    return spark.read.parquet(f"{path}/out")


@query
def stored_realtime_hours(spark, sf_dir):
    return dashboard.realtime_hours(spark, _dau_by_stream(spark, sf_dir, 2), "dau", DAY)


@query
def compacted_dau(spark, sf_dir):
    """Earlier batches merged day by day, later ones read beside them."""
    path = scratch_dir(spark, "dau")
    logs = given.startup_logs(spark, sf_dir)
    for number in range(4):
        part = dedup.first_starts(logs.filter(F.pmod(F.col("ts"), F.lit(4)) == number))
        tables.write_batch(part, tables.DAU, path, number)
        tables.compact_table(spark, tables.DAU, path, fan=2)
    return tables.read_table(spark, tables.DAU, path)


@query
def stream_order_facts(spark, sf_dir):
    path = scratch_dir(spark, "stream-orders")
    messages = _messages(given.order_payload(spark, sf_dir), schemas.ORDER)

    def start():
        raw = sources.read_topic(spark, schemas.ORDER, "json", _json(path))
        return jobs.stream_order_facts(
            raw, f"{path}/orders", f"{path}/checkpoint", jobs.AVAILABLE_NOW
        )

    replay(messages, f"{path}/topics", start, HARD_PARTS)
    return tables.read_table(spark, tables.ORDERS, f"{path}/orders").drop("arrival_ts")


@query
def stream_users(spark, sf_dir):
    path = scratch_dir(spark, "stream-users")
    messages = _messages(given.users(spark, sf_dir), schemas.USER)

    def start():
        raw = sources.read_topic(spark, schemas.USER, "json", _json(path))
        return jobs.stream_users(raw, f"{path}/users", f"{path}/checkpoint", jobs.AVAILABLE_NOW)

    replay(messages, f"{path}/topics", start, HARD_PARTS)
    return tables.read_table(spark, tables.USERS, f"{path}/users").drop("arrival_ts")


def _sales_by_stream(spark, sf_dir, orders: DataFrame, parts: int) -> DataFrame:
    path = scratch_dir(spark, "stream-sales")
    users = sales.user_snapshot(given.users(spark, sf_dir))
    tables.write_table(users, tables.USERS, f"{path}/users")
    orders = _messages(orders, schemas.ORDER)
    messages = orders.unionByName(_messages(given.details(spark, sf_dir), schemas.DETAIL))

    def start():
        raw_orders = sources.read_topic(spark, schemas.ORDER, "json", _json(path))
        raw_details = sources.read_topic(spark, schemas.DETAIL, "json", _json(path))
        return jobs.stream_sale_detail(
            spark, raw_orders, raw_details, f"{path}/users", f"{path}/sales", f"{path}/checkpoint",
            as_of=given.AS_OF, trigger=jobs.AVAILABLE_NOW,
        )

    replay(messages, f"{path}/topics", start, bounds=arrival_bounds(orders, parts, MOST_ORDERS), forget=True)
    return tables.read_table(spark, tables.SALES, f"{path}/sales").drop(*sales.ARRIVALS)


@query
def stream_sale_detail(spark, sf_dir):
    return _sales_by_stream(spark, sf_dir, given.order_payload(spark, sf_dir), 2)


@query
def stream_sale_detail_repeats(spark, sf_dir):
    """A third of the orders is delivered twice, the second time 100 s later with another status."""
    orders = given.order_payload(spark, sf_dir)
    again = orders.filter(F.col("id").cast("bigint") % 3 == 0).withColumns(
        {"order_status": F.lit("A again"), "arrival_ts": F.col("arrival_ts") + F.expr("INTERVAL 100 SECONDS")}
    )
    return _sales_by_stream(spark, sf_dir, orders.unionByName(again), HARD_PARTS)


def _unmatched_by_stream(spark, sf_dir, find) -> DataFrame:
    """What the streaming join leaves without a partner. The replay ends with a pair far ahead, so that
    the watermark passes all others."""
    path = scratch_dir(spark, "stream-unmatched")
    ahead = F.timestamp_millis(F.lit(FAR_AHEAD_MS)).alias("arrival_ts")
    one = given.table(spark, sf_dir, "region").limit(1)
    pair = one.select(F.lit("far").alias("id"), F.lit("far").alias("order_id"), ahead)
    orders = _messages(given.order_payload(spark, sf_dir), schemas.ORDER)
    messages = (
        orders.unionByName(_messages(given.details(spark, sf_dir), schemas.DETAIL))
        .unionByName(_messages(pair.drop("order_id"), schemas.ORDER))
        .unionByName(_messages(pair, schemas.DETAIL))
    )

    def start():
        o, d = (sources.read_topic(spark, t, "json", _json(path)) for t in (schemas.ORDER, schemas.DETAIL))
        found = find(record_plans.orders(o), record_plans.details(d))
        writer = found.writeStream.option("checkpointLocation", f"{path}/checkpoint")
        return writer.trigger(**jobs.AVAILABLE_NOW).format("parquet").start(f"{path}/out")

    replay(messages, f"{path}/topics", start, bounds=arrival_bounds(orders, HARD_PARTS, MOST_ORDERS), forget=True)
    return spark.read.parquet(f"{path}/out")


@query
def stream_unmatched_details(spark, sf_dir):
    def find(orders, details):
        # What is not asked for stays out of the state and of the files.
        lines = operators.join_sales(orders, details, how="left_outer").filter("order_arrival is null")
        return lines.select("order_detail_id", "order_id", "sku_id", "sku_name", "sku_price")

    return _unmatched_by_stream(spark, sf_dir, find)


@query
def stream_unmatched_orders(spark, sf_dir):
    return _unmatched_by_stream(spark, sf_dir, operators.orders_without_lines).drop("order_arrival")


@query
def stream_coupon_alert(spark, sf_dir):
    """The last windows close when time moves on, so the replay ends with one message far ahead."""
    path = scratch_dir(spark, "stream-alerts")
    events = given.event_payload(spark, sf_dir)
    messages = _messages(events, schemas.EVENT)
    ahead = events.agg(F.max("arrival_ts").alias("arrival_ts")).select(
        F.lit("none").alias("mid"), F.lit(FAR_AHEAD_MS).alias("ts"),
        F.timestamp_millis(F.lit(FAR_AHEAD_MS)).alias("arrival_ts"),
    )
    bounds = arrival_bounds(messages)

    def start():
        raw = sources.read_topic(spark, schemas.EVENT, "json", _json(path))
        return jobs.stream_coupon_alert(
            raw, f"{path}/alerts", f"{path}/checkpoint", jobs.AVAILABLE_NOW,
            window=ALERT_WINDOW, slide=ALERT_SLIDE,
        )

    replay(
        messages.unionByName(_messages(ahead, schemas.EVENT)), f"{path}/topics", start, bounds=bounds
    )
    return _text(tables.read_table(spark, tables.ALERTS, f"{path}/alerts"))
