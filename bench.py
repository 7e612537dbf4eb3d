"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then a number of times; the median counts. Results are computed
in full and thrown away by the noop sink. The streaming replay runs once. Each given table is one file
with one row group, so the tables are first copied to as many files as there are cores, as a cluster
would find them; the copy is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from retail_stream import registry  # noqa: E402
from retail_stream.session import configure  # noqa: E402

WARM = (
    "parse_event",
    "stamp_and_route_logs",
    "cdc_route",
    "dau_first_start",
    "dau_hourly_all_days",
    "new_devices",
    "realtime_total",
    "realtime_hours",
    "order_facts",
    "order_detail_full_outer",
    "sale_interval_join",
    "unmatched_details",
    "user_snapshot",
    "sale_detail",
    "coupon_alert",
)
ONCE = ("stream_dau", "stream_coupon_alert", "stream_sale_detail")


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(spark: SparkSession, sf_dir: str, cpus: int, target: str) -> str:
    """The tables the queries read, in several files each."""
    for name in ("events", "orders", "lineitem", "customer", "part", "nation"):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        rows.repartition(cpus).write.parquet(f"{target}/{name}.parquet")
    return target


def timed(spark: SparkSession, run, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = session(cpus)
    run = registry.all_queries()
    seconds: dict[str, float] = {}
    with tempfile.TemporaryDirectory() as copy:
        tables = spread(spark, sf_dir, int(cpus), f"{copy}/tables")
        for name in WARM:
            timed(spark, run[name], tables)
            seconds[name] = statistics.median(timed(spark, run[name], tables) for _ in range(repeats))
        for name in ONCE:
            seconds[name] = timed(spark, run[name], tables)
        spark.stop()
    seconds = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()
