"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_stream.scratch import SHUFFLE_CLEANUP, no_old_shuffles, scratch_dir  # noqa: F401
from retail_stream.sinks import files

# Stands for a missing doc_id where documents are ordered: it ranks after all others.
NO_ID = 2**63 - 1
# Text bytes a task works on at a time.
CHUNK_BYTES = 1 << 20
# Bytes of the Arrow batches that whole texts travel in, where only a bounded part of an executor is left for them.
BATCH_BYTES = 2 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, all of it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: a stage that lost executors do not undo."""
    path = scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def kept(frame: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """``stored`` rows and what deletes them when they have been read for the last time."""
    spark, path = frame.sparkSession, scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), lambda: files.remove(spark, path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile travels to Python in batches of about ``BATCH_BYTES``, or of one longer row. By
    default a batch is 10,000 rows, however long their texts, and each is allocated outside of the heap."""
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def doc_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NO_ID))


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in a column; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        sizes = column.cast(pa.binary() if pa.types.is_string(column.type) else column.type)
        lengths = np.diff(np.frombuffer(sizes.buffers()[1], np.int32)[sizes.offset : sizes.offset + len(sizes) + 1])
        group = np.cumsum(lengths, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)


def whole_groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames that hold whole groups, from frames sorted by the keys whose groups run on from one
    frame to the next. Only for groups of bounded size."""
    kept: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = np.ones(len(frame), bool)
        for k in keys:
            last &= (frame[k] == frame[k].iloc[-1]).to_numpy()
        first = int(np.argmax(last))
        if first or kept and any(kept[-1][k].iloc[-1] != frame[k].iloc[0] for k in keys):
            done = pd.concat([*kept, frame.iloc[:first]]) if kept else frame.iloc[:first]
            kept = []
            yield done.reset_index(drop=True)
        kept.append(frame.iloc[first:])
    if kept:
        yield pd.concat(kept).reset_index(drop=True)


def bounds(frame: pd.DataFrame, keys: list[str]) -> Iterator[tuple[int, int]]:
    """Start and end of each group of a sorted frame."""
    change = np.zeros(len(frame), bool)
    if len(frame):
        change[0] = True
    for k in keys:
        v = frame[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(change)
    yield from zip(starts, [*starts[1:], len(frame)])
