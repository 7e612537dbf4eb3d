import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import functions as F

from retail_stream import schemas
from retail_stream.plans import dashboard
from retail_stream.scratch import SETTING, scratch_dir
from retail_stream.sinks import commits, files, tables, topics
from retail_stream.sources import topics as sources
from test_dau import logs

import pytest


def written(spark, name):
    return f"{scratch_dir(spark, f'test-{name}')}/t"


def scan(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_repeated_batch_replaces_itself(spark):
    path = written(spark, "repeat")
    rows = logs(spark, ("2024-01-01", "a", 1), ("2024-01-02", "b", 2))
    for _ in range(2):
        tables.write_batch(rows, tables.DAU, path, 7)
    assert tables.read_rows(spark, tables.DAU, path).count() == 2
    tables.write_batch(rows.filter(F.col("mid") == "a"), tables.DAU, path, 7)
    assert tables.read_rows(spark, tables.DAU, path).count() == 1


def test_earliest_start_of_all_batches(spark):
    path = written(spark, "first")
    for batch, ts in enumerate((5, 3, 9)):
        tables.write_batch(logs(spark, ("2024-01-01", "a", ts)), tables.DAU, path, batch)
    rows = tables.read_table(spark, tables.DAU, path)
    assert rows.columns == list(schemas.STARTUP_COLUMNS)
    assert [r.ts for r in rows.collect()] == [3]


def shown(frame):
    return sorted((r.mid, r.ts) for r in frame.collect())


def test_merging_keeps_the_result_and_running_readers(spark):
    path = written(spark, "many")
    for batch in range(5):
        rows = logs(spark, ("2024-01-01", "a", 9 - batch), ("2024-01-01", f"n{batch}", 1), ("2024-01-02", "a", batch))
        tables.write_batch(rows, tables.DAU, path, batch)
    running = tables.read_table(spark, tables.DAU, path)
    before = commits.latest(spark, path)
    want = shown(tables.read_table(spark, tables.DAU, path))
    assert tables.compact_table(spark, tables.DAU, path, fan=4) == 8
    after = commits.latest(spark, path)
    assert [(f.value, f.level, f.batch) for f in sorted(after.folders, key=lambda f: (f.level, f.value))] == [
        ("2024-01-01", 0, 4), ("2024-01-02", 0, 4), ("2024-01-01", 1, 3), ("2024-01-02", 1, 3)
    ]
    assert shown(running) == shown(tables.read_table(spark, tables.DAU, path)) == want
    assert tables.read_rows(spark, tables.DAU, path).count() == 5 + 2 + 2
    # The newest batch may be written again, by a query that was stopped before it had noted it down.
    tables.write_batch(logs(spark, ("2024-01-01", "z", 1)), tables.DAU, path, 4)
    assert shown(tables.read_table(spark, tables.DAU, path, days=["2024-01-01"])) == [
        ("a", 6), ("n0", 1), ("n1", 1), ("n2", 1), ("n3", 1), ("z", 1)
    ]
    assert tables.read_rows(spark, tables.DAU, path, after=3).count() == 1
    assert tables.vacuum(spark, path) == 0 and shown(running) == want
    assert tables.vacuum(spark, path, keep_seconds=0) == len(before.folders)
    assert tables.read_table(spark, tables.DAU, path).count() == 7
    assert commits.latest(spark, path).gone == ()


def test_rows_without_a_key_are_merged_once(spark):
    path = written(spark, "rejects")
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    bad = spark.createDataFrame([("a/b=c", "x", "malformed", at), (None, "y", "r", at)], tables.REJECTS.schema)
    for batch in range(3):
        tables.write_batch(bad, tables.REJECTS, path, batch, fan=2)
    rows = tables.read_table(spark, tables.REJECTS, path)
    assert sorted(((r.topic or "", r.value) for r in rows.collect())) == [("", "y")] * 3 + [("a/b=c", "x")] * 3
    assert {f.value for f in commits.latest(spark, path).folders} == {"a/b=c", None}


def test_last_delivery_wins_after_merges(spark):
    """Ties in arrival go to the later batch, merged or not."""
    path = written(spark, "ties")
    for batch in range(6):
        tables.write_batch(versions(spark, ("1", f"s{batch}", "2024-01-02", 5)), tables.ORDERS, path, batch, fan=2)
    assert [r.order_status for r in tables.read_table(spark, tables.ORDERS, path).collect()] == ["s5"]
    assert max(f.level for f in commits.latest(spark, path).folders) >= 1


def test_folders_stay_few_over_five_hundred_batches(spark):
    """Commits of the DAU job at one batch every 5 s; merges as the job asks for them. What a reader of the
    day plans with, and what is read of the log, does not grow with the batches."""
    path = written(spark, "log")
    planned, read = [], []
    for batch in range(500):
        day = f"2024-01-{1 + batch // 100:02}"
        added = commits.Folder(f"part={batch}/log_date={day}", batch, day, day, day)
        commits.commit(spark, path, lambda now: commits.Change((added,), batch=batch))
        while merged := commits.due(commits.latest(spark, path), tables.FAN):
            one = commits.Folder(f"part=m{batch}-{merged[0].level}/log_date={merged[0].value}", -1, merged[0].value)
            some = [f for f in merged if f.value == one.value]
            out = tuple(f.path for f in some)
            commits.commit(spark, path, lambda now: commits.Change(commits.raised([one], some), out))
        now = commits.latest(spark, path)
        planned.append(len(commits.of_days(now.folders, [day])))
        if batch % 50 == 49:
            asked = []
            text = files.read_text
            try:
                files.read_text = lambda s, p: asked.append(p) or text(s, p)
                commits._seen.clear()  # as another process would read it
                commits.latest(spark, path)
            finally:
                files.read_text = text
            read.append(len(asked))
    assert max(planned) <= 2 * tables.FAN and max(planned[400:]) <= max(planned[:100])
    assert max(read) <= commits.SNAPSHOT_EVERY + 4
    assert len(commits.latest(spark, path).folders) <= 5 * 2 * tables.FAN
    rows = [f.batch for f in commits.latest(spark, path).folders]
    assert max(rows) == 499


def test_two_writers_at_once(spark):
    """Commits made from several threads: none is lost, none is made twice."""
    path = written(spark, "race")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(
            lambda n: commits.commit(
                spark, path, lambda now: commits.Change((commits.Folder(f"part={n}", n),), batch=n)
            ), range(40),
        ))
    now = commits.latest(spark, path)
    assert now.number == 39 and sorted(f.batch for f in now.folders) == list(range(40))


def test_users_are_looked_up_in_their_buckets(spark, settings):
    path = written(spark, "users")
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    users = spark.range(20_000).select(
        F.col("id").cast("string").alias("id"), F.lit("n").alias("login_name"), F.lit("1").alias("user_level"),
        F.lit("1990-01-01").alias("birthday"), F.lit("F").alias("gender"), F.lit(at).alias("arrival_ts"),
    )
    tables.write_batch(users, tables.USERS, path, 0)
    newer = users.filter("id % 2000 = 7").withColumn("user_level", F.lit("2"))
    tables.write_batch(newer.withColumn("arrival_ts", F.lit(at + dt.timedelta(days=1))), tables.USERS, path, 1)
    assert len({f.value for f in commits.latest(spark, path).folders}) == tables.USERS.buckets
    ids = spark.createDataFrame([("7",), ("2007",), ("8",), ("none",), (None,), ("7",)], "id string")
    few = tables.lookup(spark, tables.USERS, path, ids)
    many = tables.lookup(spark, tables.USERS, path, ids, most=2)
    for found in (few, many):
        assert sorted((r.id, r.user_level) for r in found.collect()) == [("2007", "2"), ("7", "2"), ("8", "1")]
        read = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
        assert len(read) <= 4
    line = scan(few)[0]
    assert "PushedFilters: [In(id" in line or "EqualTo(id" in line or "Or(" in line
    footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(few.inputFiles()[0]), spark._jsc.hadoopConfiguration()
        )
    ).getFooter()
    assert footer.getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0
    assert tables.lookup(spark, tables.USERS, path, ids.limit(0)).count() == 0


def test_writers_follow_the_rows(spark):
    """One day of many rows is written by as many tasks as needed, a small batch by one."""
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("mid"))
    for column, kind in tables.DAU.columns:
        if column != "mid":
            value = F.lit("2024-01-01") if column == "log_date" else F.lit(1).cast(kind)
            rows = rows.withColumn(column, value)
    large, small = written(spark, "large"), written(spark, "small")
    tables.write_batch(rows, tables.DAU, large, 0, rows_per_file=2000)
    tables.write_batch(rows.limit(100), tables.DAU, small, 0)
    assert len(spark.read.parquet(large).inputFiles()) > 10
    assert len(spark.read.parquet(small).inputFiles()) == 1
    assert tables.read_rows(spark, tables.DAU, large).count() == 40_000


def versions(spark, *rows):
    frame = spark.createDataFrame(
        [(i, s, d, dt.datetime(2024, 1, 1, 0, 0, at, tzinfo=dt.timezone.utc)) for i, s, d, at in rows],
        "id string, order_status string, create_date string, arrival_ts timestamp",
    )
    for column, kind in tables.ORDERS.columns:
        if column not in frame.columns:
            frame = frame.withColumn(column, F.lit(None).cast(kind))
    return frame


def test_last_delivery_of_an_order_wins(spark):
    path = written(spark, "versions")
    both = versions(spark, ("1", "Z_old", "2024-01-02", 0), ("1", "A_new", "2024-01-05", 50))
    tables.write_batch(both, tables.ORDERS, path, 0)
    tables.write_batch(versions(spark, ("1", "late", "2024-01-02", 20)), tables.ORDERS, path, 1)
    assert [r.order_status for r in tables.read_table(spark, tables.ORDERS, path).collect()] == ["A_new"]
    assert tables.read_table(spark, tables.ORDERS, path, days=["2024-01-02"]).count() == 0
    (row,) = tables.read_table(spark, tables.ORDERS, path, days=["2024-01-05"]).collect()
    assert row.order_status == "A_new"


def test_empty_table_is_readable(spark):
    path = written(spark, "empty")
    tables.create_table(spark, tables.SALES, path)
    assert tables.read_table(spark, tables.SALES, path).count() == 0
    assert tables.read_table(spark, tables.SALES, path).columns == list(tables.SALES.fields)


def test_a_day_reads_its_folders_and_columns_only(spark):
    path = written(spark, "prune")
    days = [f"2024-01-{d:02}" for d in range(1, 11)]
    tables.write_table(logs(spark, *[(d, m, 1) for d in days for m in "ab"]), tables.DAU, path)
    total = dashboard.dau_total(spark, path, "2024-01-03")
    (line,) = scan(total)
    assert "PartitionFilters: [isnotnull(log_date" in line and "ReadSchema: struct<mid:string>" in line
    assert total.first().total == 2
    (line,) = scan(dashboard.realtime_hours(spark, path, "dau", "2024-01-03"))
    assert "log_date" in line.split("PartitionFilters")[1]
    assert "area" not in line.split("ReadSchema")[1]
    assert dashboard.dau_hourly(spark, path, "2024-01-03").first().ct == 2
    first = written(spark, "first-days")
    rows = [("2024-01-03", "a", True), ("2024-01-04", "b", True), ("2024-01-03", "b", True), ("2024-01-04", "b", False)]
    tables.write_table(spark.createDataFrame(rows, tables.FIRST_DAYS.schema), tables.FIRST_DAYS, first)
    both = dashboard.realtime_total(spark, path, first, "2024-01-03")
    assert both.first().json.count('"value":2') == 2
    for found in (both, dashboard.new_devices(spark, first, "2024-01-03")):
        assert found.inputFiles() and all("=2024-01-03/" in f for f in found.inputFiles())
    assert dashboard.new_devices(spark, first, "2024-01-04").first().new_mids == 0
    assert dashboard.new_devices(spark, first, "no day").first().new_mids == 0


def test_orders_lie_by_month_and_filter_by_day(spark):
    path = written(spark, "orders")
    data = [(str(n), f"2024-0{1 + n % 3}-0{1 + n % 9}") for n in range(18)]
    rows = spark.createDataFrame(data, "id string, create_date string")
    for column, kind in tables.ORDERS.columns:
        if column not in rows.columns:
            rows = rows.withColumn(column, F.lit(None).cast(kind))
    tables.write_table(rows, tables.ORDERS, path)
    day = tables.read_table(spark, tables.ORDERS, path, days=["2024-02-02"])
    assert sorted(r.id for r in day.collect()) == sorted(i for i, d in data if d == "2024-02-02")
    line = next(x for x in scan(day) if "create_date" in x.split("PushedFilters")[1].split("ReadSchema")[0])
    assert "create_month" in line.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_messages_keep_their_arrival(spark):
    path = written(spark, "topics")
    arrival = dt.datetime(2024, 1, 2, 3, 4, 5, 678901, tzinfo=dt.timezone.utc)
    rows = spark.createDataFrame(
        [("start", '{"a":"b\\n"}', arrival), ("event", "oops", arrival)],
        "topic string, value string, arrival_ts timestamp",
    )
    for _ in range(2):
        topics.write_topics(rows, "json", {"path": path}, 3)
    got = sources.read_topic(spark, "start", "json", {"path": path}, streaming=False).collect()
    assert [(r.value, r.arrival_ts.astimezone(dt.timezone.utc)) for r in got] == [
        ('{"a":"b\\n"}', arrival)
    ]


def test_raw_log_lines(spark):
    path = written(spark, "lines")
    spark.createDataFrame([('{"a":1}',)], "value string").write.text(path)
    (row,) = sources.read_raw_logs(spark, path).collect()
    assert row.value == '{"a":1}' and row.arrival_ts is not None
    assert sources.read_raw_logs(spark, path, streaming=True).isStreaming


def test_unknown_formats(spark):
    with pytest.raises(ValueError):
        sources.read_messages(spark, "t", "xml", {"path": "/tmp"})
    with pytest.raises(ValueError):
        topics.write_topics(spark.range(1), "xml")


def test_print(spark, capfd):
    topics.print_rows(spark.range(30).toDF("n"), 3)
    assert "only showing top 3 rows" in capfd.readouterr().out


def test_scratch_is_below_the_named_folder(spark):
    base = spark.conf.get(SETTING, None)
    made = [scratch_dir(spark, "x") for _ in range(2)]
    assert made[0] != made[1]
    assert base is None or all(m.startswith(f"{base.rstrip('/')}/") for m in made)


def test_the_keys_of_a_day_go_to_the_rows(spark, settings, monkeypatch):
    """Whatever size Spark takes them for; too many are shuffled. The result is the same."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    path = scratch_dir(spark, "test-day-keys")
    rows = spark.range(40).selectExpr("cast(id AS string) AS id", "if(id < 10, '2024-02-02', '2024-03-03') AS create_date")
    rows = rows.withColumn("arrival_ts", F.lit(dt.datetime(2024, 1, 1))).withColumns(
        {n: F.lit(None).cast(k) for n, k in tables.ORDERS.columns if n not in ("id", "create_date", "arrival_ts")}
    )
    tables.write_batch(rows, tables.ORDERS, path, 0)
    for most, broadcast in ((10, True), (9, False)):
        monkeypatch.setattr(tables, "DAY_KEYS", most)
        day = tables.read_table(spark, tables.ORDERS, path, days=["2024-02-02"])
        assert sorted(r.id for r in day.collect()) == [str(i) for i in range(10)]
        assert ("BroadcastHashJoin" in day._jdf.queryExecution().executedPlan().toString()) is broadcast


def test_a_file_that_is_being_replaced_is_read_again(spark):
    """Its checksum is still the old one."""
    path = Path(scratch_dir(spark, "test-replaced")) / "latest"
    crc = path.with_name(".latest.crc")
    files.write_text(spark, str(path), "old")
    old = crc.read_bytes()
    files.write_text(spark, str(path), "newer", replace=True)
    new = crc.read_bytes()
    crc.write_bytes(old)
    later = threading.Timer(0.2, crc.write_bytes, [new])
    later.start()
    assert files.read_text(spark, str(path)) == "newer"
    later.join()
