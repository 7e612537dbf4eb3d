"""Plans and hot keys: what must hold when the data grows."""

import re

import pytest
from pyspark.sql import functions as F

from retail_stream import registry
from retail_stream.operators import alerts, dedup, sales
from retail_stream.plans.sale_detail import sale_details
from retail_stream.scratch import scratch_dir
from retail_stream.sources import testdata as given
from test_alerts import DAY

SMALL = "/root/testdata/sf0.001"
BATCH = [n for n in registry.all_queries() if not n.startswith("stream_")]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pair_joins_and_no_python(spark, name):
    plan = plan_of(registry.all_queries()[name](spark, SMALL))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas", plan)


@pytest.fixture
def tables_of_records(spark):
    path = scratch_dir(spark, "test-scale")
    for name in ("orders", "details", "users"):
        getattr(given, name)(spark, SMALL).write.parquet(f"{path}/{name}")
    return {n: spark.read.parquet(f"{path}/{n}") for n in ("orders", "details", "users")}


def test_lines_are_shuffled_for_the_join_and_once_for_repeats(spark, settings, tables_of_records):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    t = tables_of_records
    plan = plan_of(sale_details(t["orders"], t["details"], t["users"], "2024-01-01"))
    shuffles = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    keys = sorted(re.sub(r"#\d+L?", "", s) for s in shuffles)
    assert len(keys) == 7 and sum("order_detail_id" in k for k in keys) == 1
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    lines = next(line for line in scans if "order_price" in line)
    assert "img_url" not in lines and "sku_num" not in lines
    assert not any("consignee" in line or "login_name" in line for line in scans)


def test_starts_are_cut_before_the_shuffle(spark):
    plan = plan_of(dedup.first_starts(given.startup_logs(spark, SMALL)))
    after, before = plan.split("Exchange hashpartitioning(mid")
    assert "WindowGroupLimit" in after and "WindowGroupLimit" in before
    assert "event_type,signup" in before.split("PushedFilters")[1]
    assert before.split("ReadSchema")[1].count(":") == 4


def _skewed(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def _final_plan(frame):
    rows = frame.collect()
    return rows, plan_of(frame)


def hot(spark, n):
    """n lines and n/4 orders; a third of the lines belong to one order, a third of the orders to one
    user."""
    order = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % (n // 4)).cast("string"))
    lines = spark.range(0, n, 1, 16).select(
        F.concat(F.lit("line number "), F.col("id").cast("string")).alias("id"),
        order.alias("order_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("sku_name"),
        F.lit("s").alias("sku_id"), F.lit("1.0").alias("order_price"),
        F.timestamp_seconds(F.lit(1_704_153_600) + F.col("id") % 100).alias("arrival_ts"),
    )
    owner = F.when(F.col("k") % 3 == 0, F.lit("hot")).otherwise(F.col("k").cast("string"))
    orders = spark.range(0, n // 4, 1, 16).withColumnRenamed("id", "k").select(
        F.when(F.col("k") == 0, F.lit("hot")).otherwise(F.col("k").cast("string")).alias("id"),
        F.sha2(F.col("k").cast("string"), 256).alias("order_status"),
        F.lit("t").alias("create_time"), F.lit("2024-01-02").alias("create_date"),
        owner.alias("user_id"),
        F.timestamp_seconds(F.lit(1_704_153_600) + F.col("k") % 200).alias("arrival_ts"),
    )
    return orders, lines


def test_hot_order_and_hot_user_are_split(spark, settings):
    _skewed(spark, settings)
    n = 60_000
    orders, lines = hot(spark, n)
    joined = sales.join_sales(orders, lines)
    rows, plan = _final_plan(joined)
    expected = lines.join(orders.select(F.col("id").alias("order_id")), "order_id", "left_semi").count()
    assert len(rows) == expected >= n // 3
    assert "SortMergeJoin(skew=true)" in plan

    users = spark.range(1000).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("n").alias("login_name"), F.lit("l").alias("user_level"),
        F.lit("1990-01-01").alias("birthday"), F.lit("F").alias("gender"),
        F.current_timestamp().alias("arrival_ts"),
    )
    known = sales.enrich_users(orders, sales.user_snapshot(users), "2024-01-01")
    rows, plan = _final_plan(known)
    assert len(rows) == n // 4 and sum(r.user_level == "l" for r in rows) >= n // 12
    assert "SortMergeJoin(skew=true)" in plan


def test_repeats_of_one_order_and_line_stay_linear(spark):
    """3000 deliveries of one order and 3000 of one line: pairs would be nine million."""
    at = F.timestamp_seconds(F.lit(1_704_153_600) + F.col("id") % 900)
    orders = spark.range(3000).select(
        F.lit("1").alias("id"), F.lit("P").alias("order_status"), F.lit("t").alias("create_time"),
        F.lit("d").alias("create_date"), F.lit("u").alias("user_id"), at.alias("arrival_ts"),
    )
    lines = spark.range(3000).select(
        F.lit("a").alias("id"), F.lit("1").alias("order_id"), F.lit("n").alias("sku_name"),
        F.lit("s").alias("sku_id"), F.lit("1.0").alias("order_price"), at.alias("arrival_ts"),
    )
    candidates = sales._copies(sales.order_part(orders), 300_000_000)
    assert candidates.count() <= 4 * 3
    assert sales.join_sales(orders, lines).count() == 1
    assert sales.unmatched_orders(orders, lines).count() == 0


def test_hot_device_travels_as_panes(spark):
    """100,000 coupons of one device within a minute reach the windows as one row per pane."""
    rows = spark.range(0, 100_000, 1, 8).select(
        F.lit("m").alias("mid"), (F.col("id") % 50).cast("string").alias("uid"),
        F.lit("coupon").alias("evid"), (F.col("id") % 9).cast("string").alias("itemid"),
        (F.lit(DAY) + F.col("id") * 6 / 10).cast("bigint").alias("ts"),
    )
    found = alerts.coupon_alerts(alerts.with_event_time(rows)).collect()
    assert len(found) == 29 and {len(r.uids) for r in found} == {50}
    assert {len(r.itemIds) for r in found} == {9}


def test_settings_leave_the_master_alone():
    from retail_stream import session

    assert not any("master" in key for key in session.SETTINGS)
