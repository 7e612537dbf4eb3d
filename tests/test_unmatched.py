"""What the replay of unmatched lines and the sale table keep and write."""

from pyspark.sql import functions as F

from retail_stream import registry
from retail_stream.functions import records
from retail_stream.scratch import SHUFFLE_CLEANUP
from retail_stream.sinks import tables


def test_the_stream_writes_unmatched_lines_and_their_columns_only(spark, monkeypatch):
    at = F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("arrival_ts")
    orders = spark.createDataFrame([("1", "2024-01-01 10:00:00", 0), ("2", "2024-01-01 11:00:00", 9000)], "id string, create_time string, s long")
    lines = spark.createDataFrame(
        [("a", "1", 10), ("b", "1", 5000), ("c", "3", 0), ("d", "2", 9300), (None, None, 20)], "id string, order_id string, s long"
    )
    monkeypatch.setattr(registry.given, "order_payload", lambda *_: orders.select("id", "create_time", at))
    monkeypatch.setattr(registry.given, "details", lambda *_: lines.select(
        "id", "order_id", F.lit("k").alias("sku_id"), F.lit("n").alias("sku_name"), F.lit("1.5").alias("order_price"), at
    ))
    monkeypatch.setattr(registry.given, "table", lambda *_: spark.range(1))
    paths, scratch = [], registry.scratch_dir

    def noted(*args):
        paths.append(scratch(*args))
        return paths[-1]

    monkeypatch.setattr(registry, "scratch_dir", noted)
    found = registry.all_queries()["stream_unmatched_details"](spark, "")
    written = spark.read.parquet(f"{paths[-1]}/out")
    assert written.columns == found.columns == ["order_detail_id", "order_id", "sku_id", "sku_name", "sku_price"]
    assert sorted(r.order_detail_id for r in found.collect()) == ["b", "c"]
    assert written.count() == 2


def _small_tables(spark, monkeypatch):
    """Given tables of 40 orders with three lines each, of which the last comes too late."""
    base = F.lit(1_700_000_000)
    orders = spark.range(40).select(
        F.col("id").cast("string").alias("id"), F.lit("2024-01-01 10:00:00").alias("create_time"), (F.col("id") % 5).cast("string").alias("user_id"),
        F.lit("P").alias("order_status"), F.timestamp_seconds(base + F.col("id") * 86_400).alias("arrival_ts"),
    )
    lines = spark.range(120).select(
        F.concat(F.lit("l"), "id").alias("id"), F.when(F.col("id") != 4, F.floor(F.col("id") / 3)).cast("string").alias("order_id"),
        F.lit("k").alias("sku_id"), F.lit("n").alias("sku_name"), F.lit("1.5").alias("order_price"),
        F.timestamp_seconds(base + F.floor(F.col("id") / 3) * 86_400 + F.col("id") % 3 * 200).alias("arrival_ts"),
    )
    users = spark.createDataFrame([("1", "gold", "1990-01-01", "F")], "id string, user_level string, birthday string, gender string")
    of = {
        "order_payload": orders, "orders": records.with_create_time(orders), "details": lines,
        "users": users.withColumn("arrival_ts", F.timestamp_seconds(base)),
    }
    for name, frame in of.items():
        monkeypatch.setattr(registry.given, name, lambda *_, frame=frame: frame)
    monkeypatch.setattr(registry.given, "table", lambda _, __, name: {"lineitem": lines, "region": spark.range(1)}[name])


def test_sale_table_is_computed_in_slices(spark, monkeypatch):
    _small_tables(spark, monkeypatch)
    query = registry.all_queries()["sale_table"]
    whole = sorted(query(spark, "").collect())
    parts, write = [], tables._write

    def noted(placed, *args):
        parts.append(placed.count())
        return write(placed, *args)

    monkeypatch.setattr(tables, "_write", noted)
    monkeypatch.setattr(registry, "SLICE_LINES", 30)
    assert sorted(query(spark, "").collect()) == whole
    assert len(parts) == 4 and max(parts) < sum(parts) == len(whole) == 79


def test_shuffled_rows_of_a_written_table_are_cleaned(spark, monkeypatch):
    _small_tables(spark, monkeypatch)
    seen = []

    write = tables._write
    monkeypatch.setattr(tables, "_write", lambda *a: (seen.append(spark.conf.get(SHUFFLE_CLEANUP)), write(*a))[1])
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    registry.all_queries()["sale_table"](spark, "")
    assert seen == ["true"] and spark.conf.get(SHUFFLE_CLEANUP, None) == before
