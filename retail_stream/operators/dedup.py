"""First starts of a device per day, inside one batch and against days already stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_stream.schemas import STARTUP_COLUMNS

# The device first: its text differs early, which makes sorting by the pair cheaper.
DAU_KEY = ("mid", "log_date")
SALTS = 64


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int = 1
) -> DataFrame:
    """The ``n`` smallest rows of each key by ``order_by``, ties broken by all other columns.

    Spark cuts each key to ``n`` rows inside every map task before the shuffle, so a hot key sends
    at most ``n`` rows per task. It stops doing so from a configured ``n`` on; there each key is cut
    in salted parts first, which keeps one task from sorting a whole hot key.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ordering = [F.col(c).asc_nulls_first() for c in (*order_by, *rest)]

    def cut(rows: DataFrame, group: Sequence[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*ordering))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")

    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n >= limit:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
        df = cut(df.withColumn("_salt", salt), (*keys, "_salt")).drop("_salt")
    return cut(df, keys)


def first_starts(logs: DataFrame, n: int = 1) -> DataFrame:
    """The earliest ``n`` starts of each device on each day."""
    order = [c for c in ("ts", "uid") if c in logs.columns]
    return top_n_per_key(logs.select(*STARTUP_COLUMNS), DAU_KEY, order, n)


def drop_seen(logs: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``logs`` whose (day, device) is not in ``seen``."""
    return logs.join(seen.select(*DAU_KEY), list(DAU_KEY), "left_anti")
