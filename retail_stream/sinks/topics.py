"""Message outputs and the daily log archive."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_stream.sinks import files
from retail_stream.sources.topics import TIME_OPTIONS


# Rows of a batch that go into one file of each folder.
ROWS_PER_FILE = 500_000
# Messages repeat their field names, so their files take a fraction of the disk when compressed; readers
# tell by the ending.
COMPRESSED = {"compression": "lz4"}
# Where files wait until their batch is noted down, and the notes. Readers skip both names.
STAGED, NOTES = "_staged", "_batches"


@contextmanager
def _in_few_files(rows: DataFrame, about: int | None = None) -> Iterator[DataFrame]:
    """The rows in as many tasks as they need files, so that a short trigger does not leave a file per
    task and folder. Where the caller knows ``about`` how many there are, they are neither counted nor kept;
    else they are computed once, and rows the caller keeps are not dropped. Only rows of fewer files than
    there are cores are shuffled; more are put together where they lie."""
    own = about is None and not rows.is_cached
    if own:
        rows.persist()
    try:
        needed = max(1, -(-(rows.count() if about is None else about) // ROWS_PER_FILE))
        wide = needed >= rows.sparkSession.sparkContext.defaultParallelism
        yield rows.coalesce(needed) if wide else rows.repartition(needed)
    finally:
        if own:
            rows.unpersist()


def _publish(spark: SparkSession, path: str, staged: str, batch_id: int, writer: str) -> None:
    """Move the files of a batch to their folders, once.

    The first attempt of a batch that has written all its files notes them down. Whatever happens later,
    only files of this note are ever moved, each to a place of its own; an attempt that finds the note ends
    what the first one began and drops what it has written itself. So readers of the folders, streams among
    them, get every row of a batch once.
    """
    note = f"{path}/{NOTES}/{writer}/{batch_id}.json"
    moves = [
        (f"{staged}/{folder}/{name}", f"{path}/{folder}/batch_id={batch_id}/{writer}-{number:05}{suffix(name)}")
        for folder in files.folders_in(spark, staged)
        for number, name in enumerate(files.files_in(spark, f"{staged}/{folder}"))
    ]
    files.write_text(spark, note, json.dumps(moves))
    noted = json.loads(files.read_text(spark, note))
    for source, target in noted:
        files.move(spark, source, target)
    for folder in {staged, *("/".join(source.split("/")[:-2]) for source, _ in noted)}:
        files.remove(spark, folder)


def suffix(name: str) -> str:
    """The ending of a file name from its first dot on."""
    return name[name.index("."):] if "." in name else ""


def write_topics(
    messages: DataFrame,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    batch_id: int = 0,
    writer: str = "main",
    about: int | None = None,
) -> None:
    """Send each row's ``value`` to its ``topic``. ``about`` says how many rows there are, where that is known.

    The file form puts files into ``<path>/topic=<name>/batch_id=<n>``, those of a batch of a writer once
    and no more, however often the batch is repeated or broken off. Two jobs that send to one path need
    different names of ``writer``.
    """
    options = dict(options or {})
    if fmt == "kafka":
        messages.select("topic", "value").write.format("kafka").options(**options).save()
        return
    if fmt != "json":
        raise ValueError(f"unknown message format: {fmt!r}")
    path = options.pop("path")
    staged = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    with _in_few_files(messages.select("topic", "value", "arrival_ts"), about) as few:
        few.write.options(**COMPRESSED, **TIME_OPTIONS).options(**options).partitionBy("topic").json(staged)
    _publish(messages.sparkSession, path, staged, batch_id, writer)


@contextmanager
def staged_parts(messages: DataFrame, path: str, part: Column) -> Iterator[Callable[[int], None]]:
    """Messages of file topics written once, beside the topics, in parts of the number ``part``. What comes
    back moves one of them to its topics, as the batch of that number. Rows without a number stay out."""
    spark = messages.sparkSession
    staged = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    rows = messages.select("topic", "value", "arrival_ts", part.alias("part")).filter("part is not null")
    writer = rows.write.options(**COMPRESSED, **TIME_OPTIONS).option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.partitionBy("part", "topic").json(staged)
    made = set(files.folders_in(spark, staged))

    def publish(number: int) -> None:
        if f"part={number}" in made:
            _publish(spark, path, f"{staged}/part={number}", number, "main")

    try:
        yield publish
    finally:
        files.remove(spark, staged)


def forget_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete the messages of a batch from all topics below ``path``."""
    for folder in files.folders_in(spark, path):
        if folder.startswith("topic="):
            files.remove(spark, f"{path}/{folder}/batch_id={batch_id}")


def archive_logs(
    messages: DataFrame, path: str, batch_id: int = 0, writer: str = "main", about: int | None = None
) -> None:
    """Every stamped log as one JSON line in a folder per day and batch, once like ``write_topics``."""
    staged = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    with _in_few_files(messages.select("log_date", "value"), about) as few:
        few.write.options(**COMPRESSED).partitionBy("log_date").text(staged)
    _publish(messages.sparkSession, path, staged, batch_id, writer)


def read_archive(spark, path: str, date: str | None = None) -> DataFrame:
    """Archived logs: ``log_date``, ``value``; one day reads only that day's folders."""
    rows = spark.read.schema("value string, log_date string, batch_id bigint").text(path)
    rows = rows.select("log_date", "value")
    return rows if date is None else rows.filter(F.col("log_date") == date)


def print_rows(rows: DataFrame, n: int = 10):
    """The first ``n`` rows on the console: at once for a batch, per micro-batch for a stream."""
    if rows.isStreaming:
        return rows.writeStream.format("console").option("numRows", n).option("truncate", False)
    rows.show(n, truncate=False)
    return None
