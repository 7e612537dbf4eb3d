"""Keyed tables on files.

Every micro-batch writes folders of its own and then commits them; a batch that is repeated commits its new
folders in place of the earlier ones, so a restarted query neither loses nor doubles rows, and no file
another batch wrote is touched. Readers plan from the commit log (``commits``) and list nothing but the
folders they need. Reading keeps one row per key. A query that starts over with an empty checkpoint counts
its batches from 0 again and needs a fresh table path.

Inside a batch, rows lie in folders by day, by hash of the key or, where a backlog may span years, by month
and then sorted by day: a filter on days skips folders first and row groups next, and a replay of many years
does not write a tiny file per day and task. Where ``FAN`` folders of one day, hash or month have come
together they are merged into one, and ``FAN`` of those again, so their number grows with the logarithm of
the batches.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_stream import schemas
from retail_stream.scratch import no_old_shuffles
from retail_stream.sinks import commits, files

NO_BATCH = -1
# Folders of one day, hash or month that are merged into one.
FAN = 16
# Seconds that folders stay after a merge, for readers that have planned with them.
KEEP_SECONDS = 3600.0
# Keys that are put into the filter of a scan.
LOOKUP_KEYS = 2000
# Keys of the days asked for that are sent to all rows; more are shuffled together with them.
DAY_KEYS = 500_000
# Rows a micro-batch puts into one file; a folder gets as many files as its rows need.
ROWS_PER_FILE = 500_000


@dataclass(frozen=True)
class Table:
    """A keyed table. ``order`` ranks the rows of one key; the smallest or the largest is kept.
    ``day`` is the column that holds a row's day, ``folder`` the column folders are made by: the day
    itself, a month taken from it, one of ``buckets`` hashes of the first key column, or another column.
    Files of a table with buckets have bloom filters on that key column."""

    name: str
    key: tuple[str, ...]
    day: str | None
    folder: str | None
    columns: tuple[tuple[str, str], ...]
    order: tuple[str, ...]
    keep: str
    buckets: int = 0

    @property
    def fields(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.columns)

    @property
    def schema(self) -> T.StructType:
        return schemas.struct(self.columns)


def _typed(names: tuple[str, ...], other: dict[str, str]) -> tuple[tuple[str, str], ...]:
    return tuple((n, other.get(n, "string")) for n in names)


DAU = Table(
    "dau", ("log_date", "mid"), "log_date", "log_date",
    _typed(schemas.STARTUP_COLUMNS, {"ts": "bigint"}), ("ts", "uid"), "first",
)
ORDERS = Table(
    "order_info", ("id",), "create_date", "create_month",
    (*_typed(schemas.ORDER_COLUMNS, {"total_amount": "double"}), ("arrival_ts", "timestamp")),
    ("arrival_ts", "batch_id"), "last",
)
USERS = Table(
    "user_info", ("id",), None, "bucket",
    (*_typed(schemas.USER_COLUMNS, {}), ("arrival_ts", "timestamp")), ("arrival_ts",), "last", buckets=64,
)
SALES = Table(
    "sale_detail", ("order_id", "order_detail_id"), "dt", "month",
    (
        *_typed(schemas.SALE_COLUMNS, {"user_age": "int", "sku_price": "double"}), ("doc_id", "string"),
        ("order_arrival", "timestamp"), ("detail_arrival", "timestamp"),
    ),
    ("order_arrival", "detail_arrival", "batch_id"), "first",
)
# A device's first day; it moves to an earlier one where a row that is not present takes the later back.
FIRST_DAYS = Table(
    "first_days", ("first_day", "mid"), "first_day", "first_day",
    (("first_day", "string"), ("mid", "string"), ("present", "boolean")), ("present",), "first",
)
ALERTS = Table(
    "coupon_alert", ("mid", "ts"), None, None,
    _typed(
        schemas.ALERT_COLUMNS,
        {"uids": "array<string>", "itemIds": "array<string>", "events": "array<string>", "ts": "bigint"},
    ),
    ("batch_id",), "last",
)
REJECTS = Table(
    "rejects", (), None, "topic",
    (("topic", "string"), ("value", "string"), ("reason", "string"), ("arrival_ts", "timestamp")),
    (), "first",
)


def bucket(table: Table, key: str | None = None) -> Column:
    """The folder of a key of a table with buckets."""
    return F.pmod(F.xxhash64(key or table.key[0]), F.lit(table.buckets)).cast("int")


def _placed(rows: DataFrame, table: Table) -> DataFrame:
    """The table's columns, ``batch_id`` and, if it is none of them, the folder column."""
    rows = rows.select(*table.fields, "batch_id")
    if not table.folder or table.folder in table.fields:
        return rows
    return rows.withColumn(table.folder, bucket(table) if table.buckets else F.substring(table.day, 1, 7))


def _value(folder: str) -> str | None:
    """What a folder ``column=value`` stands for."""
    text = folder.partition("=")[2]
    if text == "__HIVE_DEFAULT_PARTITION__":
        return None
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m.group(1), 16)), text)


def _write(
    placed: DataFrame, table: Table, path: str, batch_id: int, days: dict[str, tuple[str, str]] | None = None
) -> tuple[commits.Folder, ...]:
    """Write the rows to folders no reader knows of yet. ``days`` are the days inside folders of months."""
    part = f"part={uuid.uuid4().hex}"
    writer = placed.write
    if table.folder:
        order = dict.fromkeys(c for c in (table.folder, table.day, *table.key[: bool(table.buckets)]) if c)
        writer = placed.sortWithinPartitions(*order).write.partitionBy(table.folder)
    if table.buckets:
        writer = writer.option(f"parquet.bloom.filter.enabled#{table.key[0]}", "true")
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/{part}")
    if not table.folder:
        return (commits.Folder(part, batch_id),)
    made = []
    for name in files.folders_in(placed.sparkSession, f"{path}/{part}"):
        value = _value(name)
        if table.folder == table.day:
            low, high = value, value
        else:
            low, high = (days or {}).get(value) or ((value, value) if table.day else (None, None))
        made.append(commits.Folder(f"{part}/{name}", batch_id, value, low, high))
    return tuple(made)


def _dealt(placed: DataFrame, table: Table, rows_per_file: int) -> tuple[DataFrame, int, dict]:
    """Rows dealt so that a folder gets one file for each ``rows_per_file`` rows it has, without an
    upper limit; their number; and the first and last day of each folder. Only what is known of the
    folders comes to the driver."""
    needed = lambda n: max(1, -(-n // rows_per_file))
    if not table.folder:
        n = placed.count()
        return placed.repartition(needed(n)), n, {}
    day = F.col(table.day) if table.day else F.lit(None)
    found = placed.groupBy(table.folder).agg(F.count(F.lit(1)), F.min(day), F.max(day)).collect()
    counts = {r[0]: needed(r[1]) for r in found}
    named = [F.lit(x) for k, n in counts.items() if k is not None for x in (k, n)]
    n = F.coalesce(F.create_map(*named)[F.col(table.folder)], F.lit(counts.get(None, 1))) if named else F.lit(
        counts.get(None, 1)
    )
    part = F.pmod(F.xxhash64(*(table.key or table.fields)), n.cast("bigint"))
    days = {r[0]: (r[2], r[3]) for r in found if r[2] is not None}
    dealt = placed.repartition(max(1, sum(counts.values())), table.folder, part)
    return dealt, sum(r[1] for r in found), days


def write_batch(
    rows: DataFrame, table: Table, path: str, batch_id: int, rows_per_file: int = ROWS_PER_FILE,
    fan: int | None = None,
) -> None:
    """Write and commit one micro-batch's rows, in place of an earlier attempt of the same batch.

    Writers follow the rows: one for a small batch, so that short triggers do not make millions of
    files, as many as needed for a backlog. The rows are computed once. With ``fan`` folders that have
    come together are merged afterwards.
    """
    spark = rows.sparkSession
    placed = _placed(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), table).persist()
    try:
        dealt, n, days = _dealt(placed, table, rows_per_file)
        made = _write(dealt, table, path, batch_id, days) if n else ()
    finally:
        placed.unpersist()

    def change(now: commits.Version) -> commits.Change:
        earlier = [f.path for f in now.folders if f.batch == batch_id and not f.level]
        return commits.Change(made, tuple(earlier), batch=batch_id)

    commits.commit(spark, path, change)
    if fan:
        compact_table(spark, table, path, fan, rows_per_file)


def batch_writer(
    table: Table, path: str, rows_per_file: int = ROWS_PER_FILE, fan: int | None = FAN
) -> Callable[[DataFrame, int], None]:
    """``write_batch`` in the form ``foreachBatch`` takes."""
    return lambda rows, batch_id: write_batch(rows, table, path, batch_id, rows_per_file, fan)


def write_table(rows: DataFrame, table: Table, path: str, batch_id: int = 0, slices: int = 1) -> None:
    """Write a whole batch result. The rebalance step keeps every folder to few files of even size
    and splits a folder that holds most rows.

    In ``slices`` of the first key column's hash the rows are computed one slice after the other and committed
    together: the disk holds what is shuffled for one of them beside the table, and their input is read that often.
    """
    placed = _placed(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), table)
    made: tuple[commits.Folder, ...] = ()
    with no_old_shuffles(rows.sparkSession):
        for k in range(slices):
            part = placed
            if slices > 1:
                part = placed.filter(F.pmod(F.xxhash64(table.key[0]), F.lit(slices)) == k)
            made += _write(part.hint("rebalance", table.folder) if table.folder else part, table, path, batch_id)

    def change(now: commits.Version) -> commits.Change:
        earlier = [f.path for f in now.folders if f.batch == batch_id and not f.level]
        return commits.Change(made, tuple(earlier), batch=batch_id)

    commits.commit(rows.sparkSession, path, change)


def create_table(spark: SparkSession, table: Table, path: str) -> None:
    """Commit a table without rows, if there is none."""
    commits.commit(spark, path, lambda now: commits.Change() if now.number < 0 else None)


def one_per_key(
    rows: DataFrame, table: Table, columns: Sequence[str] | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """The first or last row of each key: all columns, or the key and the ones named. With ``within``, of
    each key inside the same values of these columns.

    Filters on key columns reach the scan below, and only the columns needed are read.
    """
    wanted = table.fields if columns is None else tuple(dict.fromkeys((*table.key, *columns)))
    if not table.key:
        return rows.select(*wanted)
    keys = [*dict.fromkeys([*table.key, *within])]
    rest = [n for n in wanted if n not in keys and n not in table.order]
    ranked = F.struct(*table.order, *rest)
    best = F.min(ranked) if table.keep == "first" else F.max(ranked)
    one = rows.groupBy(*keys).agg(best.alias("row"))
    return one.select(*[n if n in keys else f"row.{n}" for n in wanted])


def _of_days(rows: DataFrame, table: Table, days: Sequence[str]) -> DataFrame:
    rows = rows.filter(F.col(table.day).isin(*days))
    if table.folder != table.day:
        rows = rows.filter(F.col(table.folder).isin(*sorted({d[:7] for d in days})))
    return rows


def _schema(table: Table) -> T.StructType:
    extra = [T.StructField("batch_id", T.LongType())]
    if table.folder and table.folder not in table.fields:
        kind = T.IntegerType() if table.buckets else T.StringType()
        extra.append(T.StructField(table.folder, kind))
    return T.StructType([*table.schema.fields, *extra])


def _read(spark: SparkSession, table: Table, path: str, folders: Sequence[commits.Folder]) -> DataFrame:
    schema = _schema(table)
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f.path}" for f in folders])
    return found.select(*schema.names)


def read_rows(
    spark: SparkSession, table: Table, *paths: str, days: Sequence[str] | None = None, after: int | None = None,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """All written rows with their ``batch_id``, keys possibly repeated; on request of some days, of batches
    after a number or of some values of the folder column only, whose folders alone are then planned with."""
    frames = []
    for path in paths:
        folders = commits.latest(spark, path).folders
        if days is not None and table.day:
            folders = commits.of_days(folders, days)
        if after is not None:
            folders = [f for f in folders if f.batch > after]
        if values is not None:
            folders = [f for f in folders if f.value in values]
        frames.append(_read(spark, table, path, folders))
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    if after is not None:
        rows = rows.filter(F.col("batch_id") > after)
    return rows if days is None else _of_days(rows, table, days)


def present(
    rows: DataFrame, table: Table, days: list[str] | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key of written rows, on request of some days.

    Where the day is no part of the key, a key's row may have moved to another day: all rows of the
    keys that were ever on the days are reduced, and then those on the days stay.
    """
    if days is None:
        return one_per_key(rows, table, columns)
    some = _of_days(rows, table, days)
    if table.day in table.key:
        return one_per_key(some, table, columns)
    keys = some.select(*table.key).distinct()
    # All written rows are held against the keys of a few days, so the keys go to the rows while they are few.
    if keys.limit(DAY_KEYS + 1).count() <= DAY_KEYS:
        keys = F.broadcast(keys)
    wanted = rows.join(keys, list(table.key), "left_semi")
    kept = None if columns is None else [*dict.fromkeys([*columns, table.day])]
    one = one_per_key(wanted, table, kept).filter(F.col(table.day).isin(*days))
    return one if columns is None else one.select(*table.key, *columns)


def read_table(
    spark: SparkSession,
    table: Table,
    *paths: str,
    days: list[str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key over one or several paths, on request of some days or columns only."""
    own = days if table.day in table.key else None
    return present(read_rows(spark, table, *paths, days=own), table, days, columns)


def lookup(spark: SparkSession, table: Table, path: str, keys: DataFrame, most: int = LOOKUP_KEYS) -> DataFrame:
    """The present rows of some keys of a table with buckets; ``keys`` has the key column.

    Only the folders of the keys' buckets are planned with, however many the table has. Up to ``most`` keys
    are put into the filter of the scan, where bloom filters skip the row groups that have none of them;
    more are joined.
    """
    (key,) = table.key
    wanted = keys.select(key).filter(F.col(key).isNotNull()).distinct().persist()
    try:
        few = wanted.select(key, bucket(table).alias("bucket")).limit(most + 1).collect()
        if len(few) <= most:
            rows = read_rows(spark, table, path, values=sorted({str(r.bucket) for r in few}))
            return one_per_key(rows.filter(F.col(key).isin([r[0] for r in few])), table)
        some = [str(r[0]) for r in wanted.select(bucket(table)).distinct().collect()]
        rows = read_rows(spark, table, path, values=some)
        return one_per_key(rows.join(wanted, key, "left_semi"), table)
    finally:
        wanted.unpersist()


def compact_table(
    spark: SparkSession, table: Table, path: str, fan: int = FAN, rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Merge folders of which ``fan`` have come together, and give the number of folders taken out.

    Rows of one key inside a folder become one; they keep the number of the batch they came with. The
    merged folders take the place of the others in one commit. Writers may go on meanwhile: if one of
    them has replaced a folder that was merged, the merge is dropped. The newest batch is never merged.
    """
    merged = commits.due(commits.latest(spark, path), fan)
    if not merged:
        return 0
    rows = _read(spark, table, path, merged)
    if table.key:
        within = [table.folder] if table.folder else []
        rows = one_per_key(rows, table, _schema(table).names, within)
    placed = rows.select(*_schema(table).names).persist()
    try:
        made = _write(_dealt(placed, table, rows_per_file)[0], table, path, NO_BATCH)
    finally:
        placed.unpersist()
    out = tuple(f.path for f in merged)

    def change(now: commits.Version) -> commits.Change | None:
        if not set(out) <= {f.path for f in now.folders}:
            return None
        return commits.Change(commits.raised(made, merged), out)

    commits.commit(spark, path, change)
    return len(merged)


def vacuum(spark: SparkSession, path: str, keep_seconds: float = KEEP_SECONDS) -> int:
    """Delete folders that were taken out at least ``keep_seconds`` ago, and give their number. Readers that
    planned with them before must have ended by then."""
    last = time.time() - keep_seconds
    old = [p for p, at in commits.latest(spark, path).gone if at <= last]
    for folder in old:
        files.remove(spark, f"{path}/{folder}")
        if "/" in folder:
            files.remove_if_empty(spark, f"{path}/{folder.rpartition('/')[0]}")
    if old:
        commits.commit(spark, path, lambda now: commits.Change(forget=tuple(old)))
    return len(old)
