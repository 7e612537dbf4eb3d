"""SimHash near-duplicates: fingerprints, a byte-position inverted index with count filtering, groups.

A fingerprint has 8 bytes; two that differ in at most 3 bits share at least 5 positional bytes. Five
of eight positions put three into one half of the fingerprint, so a linked pair is found in at least
one of 8 posting lists: three positional bytes of one half, four choices of them in either half. Pairs
that meet are tallied (positional bytes they share, 5 needed) and then verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_stream.llm.common import bounds, stored, whole_groups
from retail_stream.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
# A posting list beyond this is cut into blocks, and pairs of blocks are looked at in tasks of their own.
BLOCK = 1000
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None) -> int:
    """The signed 64-bit fingerprint of a whole text; 0 if it has no words."""
    import xxhash

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        spans = [(0, len(joined))]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        spans = zip((ends - lengths)[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, version (a hash of the text) and fp per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x) for x in batch.column(2).to_pylist()]
            yield pa.record_batch([*batch.columns[:2], pa.array(found, pa.int64())], ["doc_id", "version", "fp"])

    text = F.col("text").cast("string").alias("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("version"), text)
    return rows.mapInArrow(run, "doc_id bigint, version bigint, fp bigint")


def _postings(fps: DataFrame) -> DataFrame:
    """Eight rows per fingerprint: list number and three positional bytes in one key."""
    byte = lambda k: F.shiftright("fp", 8 * k).bitwiseAND(255)
    lists = [c for half in (0, 4) for c in combinations(range(half, half + 4), 3)]
    keys = [
        F.lit(n << 24) + F.shiftleft(byte(i), 16) + F.shiftleft(byte(j), 8) + byte(k)
        for n, (i, j, k) in enumerate(lists)
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def linked(values: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that join whatever the verified pairs among the values join: a spanning forest, at most
    one link fewer than values. Breadth first; a value leaves the list when it is reached."""
    out: list[tuple[int, int]] = []
    left = values
    low = np.uint64(0x0101010101010101)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            x = left ^ one
            t = x | (x >> np.uint64(4))
            t |= t >> np.uint64(2)
            t |= t >> np.uint64(1)
            near = np.bitwise_count(t & low) <= max_bits  # tally: at least 8 - max_bits equal bytes
            near[near] = np.bitwise_count(x[near]) <= max_bits
            if near.any():
                queue.extend(found := left[near])
                out.extend((one, f) for f in found)
                left = left[~near]
    return out


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, b: links between distinct fingerprints that keep every component whole.

    Lists of one entry are dropped. A list of more than ``block`` entries is cut into blocks by hash,
    and every pair of blocks is a cell; so no task holds a list, and none is compared in one task.
    """
    postings = stored(_postings(fps), "postings")
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("bigint")).cast("int")
    cells = (
        postings.join(sizes, "key")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("fp", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    keys = ["key", "i", "j"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            values = frame["fp"].to_numpy().view(np.uint64)
            found = [p for a, b in bounds(frame, keys) if b - a > 1 for p in linked(values[a:b])]
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, version, fp, component_id, root per row: component_id is the smallest doc_id reachable
    over links of 3 bits or fewer, root the component's smallest fingerprint.

    Equal fingerprints are one node, so copies of a text are never paired. A null text, or one without
    words, has fingerprint 0 and is linked like any other. A null doc_id is never the smallest; a
    component without any id has a null one. One row per input row, repeated ids included.
    """
    found = stored(fingerprints(docs), "fingerprints")
    nodes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = rooted.join(least, "root").select("fp", "component_id", "root")
    return found.join(groups, "fp", "left").select("doc_id", "version", "fp", "component_id", "root")
