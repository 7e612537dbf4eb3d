"""Variable-capacity best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the largest capacity are cut into pieces. Pieces are dealt into shards of about
equal token counts, each packed on its own in one task: a shard holds enough sequences for best fit to
lose next to nothing, and needs a bounded amount of memory. A sequence is opened at the capacity of
least cost for the tokens still to come, and at the end shrinks to the smallest capacity that holds it.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_stream.llm.common import WHITE, bounds, stored, whole_groups

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SHARD_TOKENS = 4_000_000
# Pieces of a shard at most, on average: short documents are many.
SHARD_PIECES = 100_000
PLACED = (
    "doc_id bigint, piece int, start bigint, n_tokens int, shard bigint, bin int, position int, capacity int"
)


def word_count() -> Column:
    """Default length where no encoded one is given: white-space separated words, and one token that ends the document."""
    text = F.trim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), WHITE, " "))
    return F.when(text == "", 1).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 2)


def cost(capacity: int, base: float = 16.0, quadratic: float = 1 / 16384) -> float:
    """What a sequence of this length costs: a fixed part, its tokens, and attention over them."""
    return base + capacity + quadratic * capacity * capacity


def pack(lengths: Sequence[int], capacities: Sequence[int]) -> list[tuple[int, int, int]]:
    """(bin, position, capacity) per piece, in the order given.

    Pieces go from long to short, ties in the order given, each into the open bin it fits best. Where
    none has room, a bin opens at the capacity whose cost per token it can hope to hold is least. That
    hope is tried with every capacity as the largest one to open, and the cheapest plan after
    downsizing wins; ties go to the smaller capacity.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    best = None
    for top in capacities:
        plan = _plan(lengths, order, [c for c in capacities if c <= top], capacities)
        if best is None or plan[0] < best[0]:
            best = plan
    return best[1] if best else []


def _plan(lengths, order, openable, capacities):
    left = sum(lengths)
    room: list[tuple[int, int]] = []
    used: list[int] = []
    held: list[int] = []
    place: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in order:
        n = lengths[i]
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fits = [c for c in openable if c >= n] or [next(c for c in capacities if c >= n)]
            free = min(fits, key=lambda c: (cost(c) / min(c, left), c))
            b = len(used)
            used.append(0)
            held.append(0)
        place[i] = (b, held[b])
        held[b] += 1
        used[b] += n
        left -= n
        if free > n:
            insort(room, (free - n, b))
    final = [next(c for c in capacities if c >= u) for u in used]
    return sum(map(cost, final)), [(b, p, final[b]) for b, p in place]


def best_fit(
    docs: DataFrame,
    length: Column | None = None,
    capacities: Sequence[int] = CAPACITIES,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Where every piece of every document goes: shard and bin name the sequence.

    One row per piece: ``start`` is its first token in the document. A document of length 0 or null
    takes no room and gets one row with a null bin. Rows that share a doc_id are packed as rows of
    their own, null ids as well. Pieces are dealt by a number each row gets when its length is stored,
    so no id, however frequent, fills a shard. Equal input files give equal packings.
    """
    capacities = sorted(capacities)
    most = capacities[-1]
    tokens = (word_count() if length is None else length).cast("bigint")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), tokens.alias("tokens"))
    lengths = stored(rows.withColumn("row", F.monotonically_increasing_id()), "lengths")
    size = lengths.filter("tokens > 0").agg(F.sum("tokens"), F.sum(F.ceil(F.col("tokens") / most))).first()
    shards = max(1, -(-(size[0] or 0) // shard_tokens), -(-(size[1] or 0) // SHARD_PIECES))
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("tokens") - 1, F.lit(0)), F.lit(most).cast("bigint"))
    pieces = lengths.filter("tokens > 0").select(
        "doc_id", "row", "tokens", F.posexplode(starts).alias("piece", "start")
    ).select(
        "doc_id", "row", "piece", "start",
        F.least(F.col("tokens") - F.col("start"), F.lit(most)).cast("int").alias("n_tokens"),
        F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).alias("shard"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["shard"]):
            for a, b in bounds(frame, ["shard"]):
                part = frame.iloc[a:b]
                placed = pack(part["n_tokens"].tolist(), capacities)
                out = part[["doc_id", "piece", "start", "n_tokens", "shard"]].copy()
                out["doc_id"] = out["doc_id"].astype("Int64")
                out[["bin", "position", "capacity"]] = placed
                yield out

    packed = (
        pieces.repartition("shard").sortWithinPartitions("shard", "row", "piece").mapInPandas(run, PLACED)
    )
    none = lambda kind: F.lit(None).cast(kind)
    empty = lengths.filter("tokens is null or tokens <= 0").select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"), F.lit(0).alias("n_tokens"),
        none("bigint").alias("shard"), none("int").alias("bin"), none("int").alias("position"),
        none("int").alias("capacity"),
    )
    return packed.unionByName(empty)
