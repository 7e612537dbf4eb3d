"""Streaming jobs: same result as the batch, after restarts, in any batch split."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from retail_stream import schemas
from retail_stream.functions import records
from retail_stream.operators import sales
from retail_stream.plans import dashboard
from retail_stream.plans.dau import daily_active
from retail_stream.scratch import scratch_dir
from retail_stream.sinks import files, tables, topics
from retail_stream.sources import topics as sources
from retail_stream.streaming import jobs, keyed_state, operators
from retail_stream.streaming.replay import LEAN, arrival_bounds, replay

DAY = 1_704_067_200_000
START = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)


@pytest.fixture(autouse=True)
def two_partitions(settings):
    settings(spark__sql__shuffle__partitions="2")


class Bus:
    """File topics and checkpoints of one test; ``send`` appends, ``run`` consumes what is new."""

    def __init__(self, spark, name):
        self.spark, self.path, self.sent = spark, scratch_dir(spark, f"test-{name}"), 0

    def send(self, messages):
        topics.write_topics(messages, "json", {"path": f"{self.path}/topics"}, self.sent)
        self.sent += 1

    def read(self, topic, streaming=True):
        return sources.read_topic(
            self.spark, topic, "json", {"path": f"{self.path}/topics"}, streaming
        )

    def run(self, job, *args, **how):
        where = (f"{self.path}/out", f"{self.path}/checkpoint")
        job(*args, *where, trigger=jobs.AVAILABLE_NOW, **how).awaitTermination()

    def table(self, table):
        return tables.read_table(self.spark, table, f"{self.path}/out")


def starts(spark, *rows):
    """Messages of (device, account, ts)."""
    frame = spark.createDataFrame(rows, "mid string, uid string, ts bigint").withColumn(
        "arrival_ts", F.timestamp_millis("ts")
    )
    return records.to_messages(frame, schemas.STARTUP)


@pytest.mark.parametrize("seed", range(2))
def test_dau_does_not_depend_on_batches(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), str(n), DAY + rng.randrange(2 * 86_400_000)) for n in range(60)]
    bus = Bus(spark, "dau")
    for part in (rows[:20], rows[20:25], rows[25:]):
        bus.send(starts(spark, *part))
        bus.run(jobs.stream_dau, bus.read(schemas.STARTUP), delay="3 days")
    expected = daily_active(starts(spark, *rows))
    assert sorted(bus.table(tables.DAU).collect()) == sorted(expected.collect())


def test_dau_repeats_across_batches(spark):
    bus = Bus(spark, "dau2")
    for ts in (20, 10, 40):
        bus.send(starts(spark, ("m", "u", DAY + ts)))
        bus.run(jobs.stream_dau, bus.read(schemas.STARTUP))
    assert [(r.mid, r.ts) for r in bus.table(tables.DAU).collect()] == [("m", DAY + 10)]


def test_dau_state_ends_with_the_day(spark):
    bus = Bus(spark, "dau3")
    raw = bus.read
    bus.send(starts(spark, ("m", "u", DAY)))
    bus.run(jobs.stream_dau, raw(schemas.STARTUP))
    bus.send(starts(spark, ("m", "u", DAY + 3 * 86_400_000)))
    query = jobs.stream_dau(
        raw(schemas.STARTUP), f"{bus.path}/out", f"{bus.path}/checkpoint", jobs.AVAILABLE_NOW
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    assert bus.table(tables.DAU).count() == 2


def test_days_follow_the_session_zone(spark, settings):
    """18:00 and 04:00 of the next day in Shanghai lie in one day of UTC."""
    settings(spark__sql__session__timeZone="Asia/Shanghai")
    hour = 3_600_000
    logs = starts(spark, ("m", "u", DAY + 10 * hour), ("m", "v", DAY + 20 * hour), ("m", "w", DAY + 15 * hour))
    bus = Bus(spark, "dau4")
    for part in (logs.filter("value like '%\"u\"%'"), logs.filter("value not like '%\"u\"%'")):
        bus.send(part)
        bus.run(jobs.stream_dau, bus.read(schemas.STARTUP))
    rows = sorted((r.log_date, r.uid) for r in bus.table(tables.DAU).collect())
    assert rows == [("2024-01-01", "u"), ("2024-01-02", "v")]
    assert sorted(rows) == sorted((r.log_date, r.uid) for r in daily_active(logs).collect())


def test_a_device_is_stored_once_a_day(spark):
    bus = Bus(spark, "dau5")
    for ts in (10, 20, 30, 40):
        bus.send(starts(spark, ("m", "u", DAY + ts), ("n", "u", DAY + 50)))
        bus.run(jobs.stream_dau, bus.read(schemas.STARTUP))
    assert tables.read_rows(spark, tables.DAU, f"{bus.path}/out").count() == 2


def test_late_rows_are_counted(spark):
    bus = Bus(spark, "late")
    for day in (5, 0):
        bus.send(starts(spark, ("m", "u", DAY + day * 86_400_000)))
        query = jobs.stream_dau(
            bus.read(schemas.STARTUP), f"{bus.path}/out", f"{bus.path}/checkpoint", jobs.AVAILABLE_NOW
        )
        query.awaitTermination()
    assert jobs.late_rows(query) == 1
    assert [r.log_date for r in bus.table(tables.DAU).collect()] == ["2024-01-06"]


def events(spark, *rows):
    """Messages of (device, account, event, second)."""
    data = [(m, u, e, "i", DAY + s * 1000) for m, u, e, s in rows]
    frame = spark.createDataFrame(data, "mid string, uid string, evid string, itemid string, ts bigint")
    timed = frame.withColumn("arrival_ts", F.timestamp_millis("ts"))
    return records.to_messages(timed, schemas.EVENT)


@pytest.mark.parametrize("click, alerts", [(True, 0), (False, 10)])
def test_click_in_a_later_batch_cancels(spark, click, alerts):
    bus = Bus(spark, "alert")
    batches = [
        [("m", a, "coupon", 0) for a in "abc"],
        [("m", "d", "clickItem", 0)] if click else [("n", "d", "clickItem", 0)],
        [("far", "x", "other", 86_400)],
    ]
    for batch in batches:
        bus.send(events(spark, *batch))
        bus.run(jobs.stream_coupon_alert, bus.read(schemas.EVENT))
    assert bus.table(tables.ALERTS).count() == alerts


def at(second):
    return START + dt.timedelta(seconds=second)


def orders(spark, *rows):
    data = [(i, u, "2024-01-02 00:00:00", "13812345678", at(s)) for i, u, s in rows]
    frame = spark.createDataFrame(
        data, "id string, user_id string, create_time string, consignee_tel string, arrival_ts timestamp"
    )
    return records.to_messages(frame, schemas.ORDER)


def details(spark, *rows):
    data = [(i, o, "9.5", at(s)) for o, i, s in rows]
    frame = spark.createDataFrame(
        data, "id string, order_id string, order_price string, arrival_ts timestamp"
    )
    return records.to_messages(frame, schemas.DETAIL)


def users(spark, *rows):
    data = [(i, level, "1995-05-05", "F", at(s)) for i, level, s in rows]
    frame = spark.createDataFrame(
        data, "id string, user_level string, birthday string, gender string, arrival_ts timestamp"
    )
    return records.to_messages(frame, schemas.USER)


def test_sale_detail(spark):
    bus = Bus(spark, "sale")
    people = f"{bus.path}/users"
    tables.create_table(spark, tables.USERS, people)

    def learn(*rows):
        bus.send(users(spark, *rows))
        query = jobs.stream_users(
            bus.read(schemas.USER), people, f"{bus.path}/users-checkpoint", jobs.AVAILABLE_NOW
        )
        query.awaitTermination()

    def step(some_orders, some_lines):
        bus.send(orders(spark, *some_orders).unionByName(details(spark, *some_lines)))
        jobs.stream_sale_detail(
            spark, bus.read(schemas.ORDER), bus.read(schemas.DETAIL), people, f"{bus.path}/out",
            f"{bus.path}/checkpoint", as_of="2024-01-01", trigger=jobs.AVAILABLE_NOW,
        ).awaitTermination()

    learn(("u", "old", 0))
    # Line before its order, order before its line, both in one batch, a repeat, and two too far away.
    step([("1", "u", 0)], [("1", "same", 0), ("2", "early", 10), ("3", "lost", 0), ("1", "late", 301)])
    learn(("u", "new", 5))
    step([("2", "u", 310), ("3", "ghost", 301)], [("1", "last", 300), ("1", "same", 1)])
    got = {
        (r.order_id, r.order_detail_id): (r.user_level, r.user_age, r.sku_price, r.doc_id, r.dt)
        for r in bus.table(tables.SALES).collect()
    }
    assert got == {
        ("1", "same"): ("old", 28, 9.5, "1-same", "2024-01-02"),
        ("2", "early"): ("new", 28, 9.5, "2-early", "2024-01-02"),
        ("1", "last"): ("new", 28, 9.5, "1-last", "2024-01-02"),
    }


def test_sale_detail_before_any_user(spark):
    bus = Bus(spark, "sale2")
    people = f"{bus.path}/users"
    tables.create_table(spark, tables.USERS, people)
    bus.send(orders(spark, ("1", "u", 0)).unionByName(details(spark, ("1", "a", 0))))
    jobs.stream_sale_detail(
        spark, bus.read(schemas.ORDER), bus.read(schemas.DETAIL), people, f"{bus.path}/out",
        f"{bus.path}/checkpoint", trigger=jobs.AVAILABLE_NOW,
    ).awaitTermination()
    assert [(r.user_level, r.user_age) for r in bus.table(tables.SALES).collect()] == [(None, 0)]


def collected(spark, frame, bus, name):
    target = f"{bus.path}/{name}"
    query = (
        frame.writeStream.option("checkpointLocation", f"{bus.path}/{name}-checkpoint")
        .trigger(availableNow=True)
        .format("parquet")
        .start(target)
    )
    query.awaitTermination()
    return spark.read.schema(frame.schema).parquet(target).collect()


def test_unmatched_come_out_when_time_has_passed(spark):
    from retail_stream.plans import records as plans

    bus = Bus(spark, "unmatched")
    later = 100_000
    bus.send(
        orders(spark, ("1", "u", 0), ("2", "u", 0), ("x", "u", later)).unionByName(
            details(spark, ("1", "a", 10), ("3", "b", 10), ("x", "c", later))
        )
    )
    o, d = plans.orders(bus.read(schemas.ORDER)), plans.details(bus.read(schemas.DETAIL))
    lonely = collected(spark, operators.join_sales(o, d, how="left_outer"), bus, "lines")
    assert [r.order_detail_id for r in lonely if r.order_arrival is None] == ["b"]
    assert sorted(r.order_detail_id for r in lonely) == ["a", "b", "c"]
    o, d = plans.orders(bus.read(schemas.ORDER)), plans.details(bus.read(schemas.DETAIL))
    assert [r.order_id for r in collected(spark, operators.orders_without_lines(o, d), bus, "o")] == ["2"]


def test_order_facts_and_rejects(spark):
    bus = Bus(spark, "orders")
    bad = spark.createDataFrame([("oops",)], "value string").select(
        F.lit("order_info").alias("topic"), "value", F.lit(at(0)).alias("arrival_ts")
    )
    bus.send(orders(spark, ("1", "u", 0), ("2", "u", 1)).unionByName(bad))
    bus.run(jobs.stream_order_facts, bus.read(schemas.ORDER))
    bus.send(orders(spark, ("2", "v", 2)))
    bus.run(jobs.stream_order_facts, bus.read(schemas.ORDER))
    rows = {r.id: r for r in bus.table(tables.ORDERS).collect()}
    assert {i: (r.user_id, r.consignee_tel) for i, r in rows.items()} == {
        "1": ("u", "1381*******"), "2": ("v", "1381*******"),
    }
    jobs.stream_rejects(
        bus.read(schemas.ORDER), schemas.ORDER, f"{bus.path}/bad", f"{bus.path}/bad-checkpoint",
        jobs.AVAILABLE_NOW,
    ).awaitTermination()
    bad_rows = tables.read_table(spark, tables.REJECTS, f"{bus.path}/bad").collect()
    assert [(r.topic, r.value, r.reason) for r in bad_rows] == [("order_info", "oops", "malformed")]


def test_log_and_change_intake(spark):
    bus = Bus(spark, "intake")
    raw = spark.createDataFrame(
        [('{"type":"startup","mid":"m"}',), ('{"type":"event","mid":"m"}',), ("oops",)], "value string"
    ).select(F.lit("logs").alias("topic"), "value", F.lit(at(0)).alias("arrival_ts"))
    bus.send(raw)
    logs = sources.read_messages(spark, "logs", "json", {"path": f"{bus.path}/topics"})
    jobs.stream_ingest_logs(
        logs, {"path": f"{bus.path}/made"}, f"{bus.path}/archive", f"{bus.path}/bad",
        f"{bus.path}/checkpoint", fmt="json", prefix="p_", trigger=jobs.AVAILABLE_NOW,
    ).awaitTermination()
    made = {"path": f"{bus.path}/made"}
    for topic, kind in ((schemas.STARTUP, "startup"), (schemas.EVENT, "event")):
        values = sources.read_topic(spark, topic, "json", made, False, "p_").collect()
        assert [r.value for r in values] == [
            f'{{"type":"{kind}","mid":"m","ts":{int(at(0).timestamp() * 1000)}}}'
        ]
    assert topics.read_archive(spark, f"{bus.path}/archive", "2024-01-02").count() == 2
    assert topics.read_archive(spark, f"{bus.path}/archive", "2024-01-03").count() == 0
    assert [r.value for r in tables.read_table(spark, tables.REJECTS, f"{bus.path}/bad").collect()] == [
        "oops"
    ]

    change = (
        '{"entry_type":"ROWDATA","schema_name":"s","table_name":"user_info","event_type":"UPDATE",'
        '"rows":[{"after":[{"name":"id","value":"5"}]}]}'
    )
    broken = ("oops", change[:-20], change.replace('[{"after', '5, [{"after'), change.split(',"rows"')[0] + "}")
    bus.send(
        spark.createDataFrame([(x,) for x in (change, *broken)], "value string").select(
            F.lit("changes").alias("topic"), "value", F.lit(at(0)).alias("arrival_ts")
        )
    )
    feed = sources.read_messages(spark, "changes", "json", {"path": f"{bus.path}/topics"})
    jobs.stream_ingest_changes(
        feed, made, f"{bus.path}/bad-changes", f"{bus.path}/changes-checkpoint", fmt="json",
        trigger=jobs.AVAILABLE_NOW,
    ).awaitTermination()
    assert [r.value for r in sources.read_topic(spark, "user_info", "json", made, False).collect()] == [
        '{"id":"5"}'
    ]
    bad = tables.read_table(spark, tables.REJECTS, f"{bus.path}/bad-changes").collect()
    assert sorted((r.value, r.reason) for r in bad) == sorted(zip(broken, ["malformed"] * 3 + ["no rows"]))


def test_repeated_order_gives_the_same_sale_as_the_batch(spark):
    bus = Bus(spark, "again")
    people = f"{bus.path}/users"
    tables.create_table(spark, tables.USERS, people)
    for order in (("1", "NEW", 5), ("1", "OLD", 0)):
        bus.send(orders(spark, order).unionByName(details(spark, ("1", "a", 3))))
        jobs.stream_sale_detail(
            spark, bus.read(schemas.ORDER), bus.read(schemas.DETAIL), people, f"{bus.path}/out",
            f"{bus.path}/checkpoint", trigger=jobs.AVAILABLE_NOW,
        ).awaitTermination()
    assert [r.user_id for r in bus.table(tables.SALES).collect()] == ["OLD"]


def test_stream_join_equals_batch_join(spark):
    rng = random.Random(7)
    some = [(str(n), "u", rng.randrange(2000)) for n in range(30)]
    lines = [(str(rng.randrange(35)), str(n), rng.randrange(2000)) for n in range(120)]
    bus = Bus(spark, "join")
    people = f"{bus.path}/users"
    tables.create_table(spark, tables.USERS, people)
    for low in (0, 700, 1400):
        inside = lambda s: low <= s < low + 700  # noqa: B023, E731
        bus.send(
            orders(spark, *[r for r in some if inside(r[2])]).unionByName(
                details(spark, *[r for r in lines if inside(r[2])])
            )
        )
        jobs.stream_sale_detail(
            spark, bus.read(schemas.ORDER), bus.read(schemas.DETAIL), people, f"{bus.path}/out",
            f"{bus.path}/checkpoint", trigger=jobs.AVAILABLE_NOW,
        ).awaitTermination()
    from retail_stream.plans import records as plans

    batch = sales.join_sales(plans.orders(orders(spark, *some)), plans.details(details(spark, *lines)))
    key = lambda rows: sorted((r.order_id, r.order_detail_id) for r in rows)
    assert key(bus.table(tables.SALES).collect()) == key(batch.collect()) != []


def test_a_message_is_delivered_once_however_often_its_batch_breaks(spark, monkeypatch):
    """A writer is stopped between its files; a reader runs before and after it is repeated."""
    path = scratch_dir(spark, "test-once")
    rows = spark.range(3_000).selectExpr(
        "concat('t', id % 3) AS topic", "concat('m', id) AS value", "timestamp_millis(id) AS arrival_ts"
    ).repartition(3)
    moved = files.move

    def broken(*a):
        broken.left -= 1
        if broken.left < 0:
            raise OSError("stopped")
        moved(*a)

    def read():
        raw = sources.read_messages(spark, "t0", "json", {"path": path})
        out = raw.writeStream.option("checkpointLocation", f"{path}-c").trigger(**jobs.AVAILABLE_NOW)
        out.format("parquet").start(f"{path}-out").awaitTermination()
        return sorted(r.value for r in spark.read.parquet(f"{path}-out").collect())

    topics.write_topics(rows.filter("value = 'm0'"), "json", {"path": path}, 0)
    assert read() == ["m0"]
    for left in (1, 2):
        broken.left = left
        monkeypatch.setattr(files, "move", broken)
        with pytest.raises(OSError):
            topics.write_topics(rows.repartition(2), "json", {"path": path}, 1)
        monkeypatch.setattr(files, "move", moved)
        read()
    topics.write_topics(rows.repartition(5), "json", {"path": path}, 1)
    topics.write_topics(rows, "json", {"path": path}, 1)
    assert read() == sorted(["m0", *[f"m{i}" for i in range(0, 3000, 3)]])
    for other in ("t1", "t2"):
        assert sources.read_messages(spark, other, "json", {"path": path}, streaming=False).count() == 1000


def test_first_day_moves_to_an_earlier_one(spark):
    bus = Bus(spark, "first-days")
    for batch in ([("a", "u", DAY + 2 * 86_400_000), ("b", "u", DAY)], [("a", "u", DAY + 86_400_000)],
                  [("a", "u", DAY + 3 * 86_400_000), ("b", "u", DAY)], [("a", "u", DAY), ("a", "v", DAY + 86_400_000)]):
        bus.send(starts(spark, *batch))
        bus.run(jobs.stream_first_days, bus.read(schemas.STARTUP))
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert [dashboard.new_devices(spark, f"{bus.path}/out", d).first().new_mids for d in days] == [2, 0, 0, 0]
    # Devices that were known and bring nothing earlier are not written again.
    assert tables.read_rows(spark, tables.FIRST_DAYS, f"{bus.path}/out").count() == 2 + 2 + 0 + 2


def test_a_second_write_prolongs_a_value(spark):
    path = scratch_dir(spark, "test-held")
    steps = [
        [("k", 0, True, "x"), ("k", 10, False, "p10"), ("k", 20, True, "y"), ("w", 0, True, ""), ("v", 1, True, "")],
        [("k", 29, False, "p29"), ("k", 30, False, "p30"), ("other", 30, False, "q")],
        [("k", 31, False, "p31"), ("k", 40, True, "z"), ("k", 40, False, "p40"), ("k", 50, False, "p50")],
        [("far", 500, True, "end")],
        [("far", 600, True, "end")],
    ]
    sizes = []
    for number, rows in enumerate(steps):
        data = [(k, at(s), w, v) for k, s, w, v in rows]
        made = spark.createDataFrame(data, "key string, event_time timestamp, write boolean, value string")
        made.coalesce(1).write.parquet(f"{path}/in/{number}")
        stream = spark.readStream.schema(made.schema).parquet(f"{path}/in/*").withWatermark("event_time", "1 second")
        query = keyed_state.held_values(stream, 10).writeStream.outputMode("append").format("parquet").option(
            "checkpointLocation", f"{path}/c").trigger(**jobs.AVAILABLE_NOW).start(f"{path}/out")
        query.awaitTermination()
        kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
        sizes.append((max(kept), kept[-1]))
    found = {r.probe: r.value for r in spark.read.parquet(f"{path}/out").collect()}
    assert found == {"p10": "x", "p29": "y", "p30": "y", "q": None, "p31": None, "p40": None, "p50": "z"}
    # Two of three keys have ended by the close of the first run, "k" by that of the last.
    assert sizes[0] == (3, 1) and sizes[-1][1] == 1


def test_late_rows_come_out_with_a_reason(spark):
    bus = Bus(spark, "late")
    hour = 3_600_000
    batches = [[("a", "u", DAY)], [("b", "u", DAY + 5 * hour), ("c", "u", DAY + 2 * hour)],
               [("d", "u", DAY + 4 * hour), ("e", "u", DAY + 3 * hour), ("f", "u", DAY)], [("g", "u", DAY + 4 * hour - 1)]]
    for batch in batches:
        bus.send(starts(spark, *batch))
        bus.run(lambda raw, *a, **k: jobs.stream_late_rows(raw, schemas.STARTUP, *a, delay="1 HOUR", **k), bus.read(schemas.STARTUP))
    rows = bus.table(tables.REJECTS).collect()
    assert {r.reason for r in rows} == {"late"} and {r.topic for r in rows} == {"start"}
    assert sorted(r.value.split('"mid":"')[1][0] for r in rows) == ["e", "f", "g"]


def test_alert_state_does_not_grow_with_accounts(spark):
    """A device with 50,000 accounts and a click: what is kept for its windows has one row each."""
    bus = Bus(spark, "many-accounts")
    claims = spark.range(50_000).select(
        F.lit("m").alias("mid"), F.col("id").cast("string").alias("uid"), F.lit("coupon").alias("evid"),
        F.lit("1").alias("itemid"), F.lit(DAY).alias("ts"), F.timestamp_millis(F.lit(DAY)).alias("arrival_ts"),
    )
    bus.send(records.to_messages(claims, schemas.EVENT).unionByName(events(spark, ("m", "x", "clickItem", 0))))
    query = jobs.stream_coupon_alert(
        bus.read(schemas.EVENT), f"{bus.path}/out", f"{bus.path}/checkpoint", jobs.AVAILABLE_NOW
    )
    query.awaitTermination()
    first = next(p for p in query.recentProgress if p["numInputRows"])
    by_name = {}
    for s in first["stateOperators"]:
        by_name.setdefault(s["operatorName"], []).append(s["numRowsTotal"])
    assert sorted(by_name["stateStoreSave"]) == [0, 10]
    bus.send(events(spark, ("far", "x", "other", 86_400)))
    bus.run(jobs.stream_coupon_alert, bus.read(schemas.EVENT))
    assert bus.table(tables.ALERTS).count() == 0


def test_live_trigger_works_a_backlog_off_in_bounded_steps(spark):
    """A processing-time run: six files, two for each micro-batch, whose parts are reported."""
    bus = Bus(spark, "live")
    for n in range(6):
        bus.send(starts(spark, *[(f"d{n}-{i}", "u", DAY + n) for i in range(10)]))
    raw = sources.read_topic(spark, schemas.STARTUP, "json", {"path": f"{bus.path}/topics"}, most=2)
    query = jobs.stream_dau(raw, f"{bus.path}/out", f"{bus.path}/checkpoint", {"processingTime": "1 second"})
    try:
        for _ in range(240):
            if sum(p["rows"] for p in jobs.batch_parts(query)) >= 60:
                break
            time.sleep(0.5)
        query.processAllAvailable()
    finally:
        query.stop()
    worked = [p for p in jobs.batch_parts(query) if p["rows"]]
    assert [p["rows"] for p in worked] == [20, 20, 20]
    assert worked[-1]["state_rows"] == 60 and all(p["late"] == 0 for p in worked)
    assert all(p["triggerExecution"] >= p["addBatch"] > 0 for p in worked)
    assert bus.table(tables.DAU).count() == 60


def test_a_replay_computes_and_writes_its_messages_once(spark):
    path, seen = scratch_dir(spark, "test-replay"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "topic string, value string, arrival_ts timestamp"
    made = spark.range(300).selectExpr("'t' AS topic", "concat('m', id) AS value", "timestamp_millis(id) AS arrival_ts")
    runs = []

    def start():
        raw = sources.read_messages(spark, "t", "json", {"path": path})
        out = raw.writeStream.option("checkpointLocation", f"{path}-c").trigger(**jobs.AVAILABLE_NOW)
        runs.append(out.format("parquet").start(f"{path}-out"))
        return runs[-1]

    replay(made.mapInArrow(count, schema), path, start, bounds=[100_000, 200_000])
    assert seen.value == 300
    assert [sum(p["numInputRows"] for p in q.recentProgress) for q in runs] == [100, 100, 100]
    assert sorted(r.value for r in spark.read.parquet(f"{path}-out").collect()) == sorted(f"m{i}" for i in range(300))
    batches = [f"{path}/topic=t/batch_id={i}" for i in range(3)]
    assert all(name.endswith(".lz4") for b in batches for name in files.files_in(spark, b))


def test_parts_of_a_replay_hold_a_bounded_number_of_messages(spark):
    """Nine tenths arrive in the first second of a year."""
    rows = spark.range(1000).selectExpr("timestamp_millis(if(id < 900, id, id * 31536000)) AS arrival_ts")
    assert len(arrival_bounds(rows, 5)) == 4 == len(arrival_bounds(rows, 5, 200))
    bounds = arrival_bounds(rows, 5, 100)
    at = sorted(r[0] for r in rows.select(F.unix_micros("arrival_ts")).collect())
    parts = [sum(lo <= x < hi for x in at) for lo, hi in zip([0, *bounds], [*bounds, 1 << 62])]
    assert sum(parts) == 1000 and max(parts) <= 110


def test_the_sale_job_runs_no_batch_without_messages(spark):
    """The watermark moves on after the first batch; an inner join has nothing to give for that."""
    bus = Bus(spark, "no-empty")
    people = f"{bus.path}/users"
    tables.create_table(spark, tables.USERS, people)
    before = spark.conf.get(jobs.EMPTY_BATCHES)
    for second in (0, 100_000):
        bus.send(orders(spark, (f"o{second}", "u", second)).unionByName(details(spark, (f"o{second}", "a", second))))
        query = jobs.stream_sale_detail(
            spark, bus.read(schemas.ORDER), bus.read(schemas.DETAIL), people, f"{bus.path}/out",
            f"{bus.path}/checkpoint", trigger=jobs.AVAILABLE_NOW,
        )
        query.awaitTermination()
        assert {p["batchId"] for p in query.recentProgress if p["durationMs"].get("addBatch")} == {second // 100_000}
    assert spark.conf.get(jobs.EMPTY_BATCHES) == before
    assert bus.table(tables.SALES).count() == 2


def test_first_days_ask_the_state_once_per_device():
    """Each call is a message to the JVM."""
    calls = []

    class Day:
        def get(self):
            calls.append("get")
            return ("2024-01-02",)

        def update(self, value):
            calls.append(value)

    of = keyed_state._FirstDay()
    of._day = Day()
    days = lambda *found: [tuple(r) for r in of.handleInputRows(("m",), iter([Row(mid="m", log_date=d) for d in found]), None)]
    assert days("2024-01-03", "2024-01-02") == [] and calls == ["get"]
    assert days("2024-01-03", "2024-01-01") == [("2024-01-01", "m", True), ("2024-01-02", "m", False)]
    assert calls == ["get", "get", ("2024-01-01",)]


def test_a_replay_keeps_little_more_than_its_next_run_needs(spark):
    """Twelve parts: messages of ended parts are gone, and of old batches the log and the state."""
    path, before = scratch_dir(spark, "test-lean"), {k: spark.conf.get(k, None) for k in LEAN}
    made = spark.range(120).selectExpr("'t' AS topic", "cast(id % 7 AS string) AS value", "timestamp_millis(id * 1000) AS arrival_ts")
    seen = []

    def start():
        raw = sources.read_messages(spark, "t", "json", {"path": path}).groupBy("value").count()
        seen.append(sorted(f for f in files.folders_in(spark, f"{path}/topic=t")))
        assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "2"
        out = raw.writeStream.outputMode("complete").option("checkpointLocation", f"{path}-c").trigger(**jobs.AVAILABLE_NOW)
        return out.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{path}-out")).start()

    replay(made, path, start, bounds=[10_000_000 * i for i in range(1, 12)], forget=True)
    assert seen == [[f"batch_id={i}"] for i in range(12)]
    assert files.folders_in(spark, f"{path}/topic=t") == []
    assert len(files.files_in(spark, f"{path}-c/commits")) <= 3
    assert sum(r["count"] for r in spark.read.parquet(f"{path}-out").collect()) == 120
    assert {k: spark.conf.get(k, None) for k in LEAN} == before


def test_changes_are_parsed_once_for_topics_and_rejects(spark, monkeypatch):
    path, raw, decode = scratch_dir(spark, "test-changes"), [], sources.decoded_changes

    def noted(frame):
        raw.append("reason" not in frame.columns)
        return decode(frame)

    monkeypatch.setattr(sources, "decoded_changes", noted)
    good = (
        '{"entry_type":"ROWDATA","schema_name":"s","table_name":"user_info","event_type":"UPDATE",'
        '"rows":[{"after":[{"name":"id","value":"5"}]}]}'
    )
    rows = spark.createDataFrame([(good,), ("oops",), ("{}",), (None,)], "value string")
    topics.write_topics(rows.select(F.lit("changes").alias("topic"), "value", F.lit(at(0)).alias("arrival_ts")), "json", {"path": path})
    feed = sources.read_messages(spark, "changes", "json", {"path": path})
    jobs.stream_ingest_changes(
        feed, {"path": f"{path}-made"}, f"{path}-bad", f"{path}-c", fmt="json", trigger=jobs.AVAILABLE_NOW
    ).awaitTermination()
    assert raw.count(True) == 1
    made = sources.read_topic(spark, schemas.USER, "json", {"path": f"{path}-made"}, streaming=False)
    assert [r.value for r in made.collect()] == ['{"id":"5"}']
    bad = tables.read_table(spark, tables.REJECTS, f"{path}-bad").collect()
    assert sorted((r.value or "", r.reason) for r in bad) == [("", "malformed"), ("oops", "malformed"), ("{}", "missing key")]
