"""Replay of stored messages through the streaming jobs, in arrival order and in several runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retail_stream.sinks.topics import forget_batch, staged_parts

# A run goes on from the last batch of the one before, so older state need not stay: neither its files, of which
# Spark keeps a hundred batches, nor a second copy in memory. A snapshot after every fourth batch lets files go
# and bounds what a restart reads.
LEAN = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "4",
}


@contextmanager
def lean_state(spark: SparkSession) -> Iterator[None]:
    """Queries started meanwhile keep what a restart needs and little more."""
    before = {key: spark.conf.get(key, None) for key in LEAN}
    for key, value in LEAN.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def arrival_bounds(messages: DataFrame, parts: int = 2, most: int | None = None) -> list[int]:
    """``parts - 1`` arrival times in microseconds that cut the messages' span evenly. Where parts would hold
    more than ``most`` messages on average, as many times more as it takes, between even numbers of messages:
    what a micro-batch keeps does not grow with the input."""
    at = F.unix_micros("arrival_ts")
    first, last, n = messages.agg(F.min(at), F.max(at), F.count(at)).first()
    if first is None:
        return []
    if most is None or n <= most * parts:
        return [first + (last - first) * i // parts for i in range(1, parts)]
    parts = -(-n // most)
    cuts = messages.agg(F.percentile_approx(at, [i / parts for i in range(1, parts)])).first()[0]
    return sorted({c for c in cuts if c > first})


def replay(
    messages: DataFrame,
    topic_path: str,
    start: Callable[[], StreamingQuery],
    parts: int = 2,
    bounds: list[int] | None = None,
    forget: bool = False,
) -> None:
    """Append the messages to file topics part by part and run the query once after each.

    The messages are computed and written once, all parts together, and a part's files moved to the topics
    when its turn comes. Every run is a restart from the checkpoint. A part is read as one micro-batch, so
    within the replay no row arrives after a later part's watermark. With ``forget`` the messages of a part are
    deleted when its run has ended, for topics that nobody reads again.
    """
    spark = messages.sparkSession
    bounds = arrival_bounds(messages, parts) if bounds is None else bounds
    at = F.unix_micros("arrival_ts")
    number = reduce(add, [(at >= b).cast("int") for b in bounds], F.lit(0))
    with staged_parts(messages, topic_path, number) as publish:
        for part in range(len(bounds) + 1):
            publish(part)
            with lean_state(spark):
                run = start()
            run.awaitTermination()
            if forget:
                forget_batch(spark, topic_path, part)
