"""Exact copies of whole texts by compressed radix tries over ranges of adaptive text prefixes.

Every task first puts its own texts into a trie and hands on each distinct text once, with the smallest
id and the counts of its documents, so that a text held by a third of all rows leaves a task as one row.
Prefixes are then lengthened where many texts share them; ranges of these prefixes are the partitions,
and inside a partition texts come sorted, so that a trie holds no more than a bounded stretch of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_stream.llm.common import NO_ID, stored

# Text bytes a trie holds before its terminals are handed on.
TRIE_BYTES = 16 << 20
# Bytes a partition is meant to hold, and bytes and texts under one prefix, while the corpus is small ...
TASK_BYTES = 8 << 20
PREFIX_BYTES = 1 << 20
PREFIX_TEXTS = 256
# ... and the most partitions, and long prefixes of one level, there may be: a large corpus has larger ones.
PIECES = 1 << 16
FIRST_PREFIX = 4
# How the documents of one text are kept: one entry per group, its documents and those of the smallest id.
TERMINALS = "text string, n_bytes bigint, kind int, least bigint, groups array<string>, docs array<bigint>, firsts array<bigint>"
MARKED = f"{TERMINALS}, marks array<bigint>"


def _shared(a: bytes, i: int, b: bytes, j: int, end_b: int) -> int:
    """Equal bytes of a from i on and b from j to ``end_b``."""
    low, high = 0, min(len(a) - i, end_b - j)
    step = 16
    while low < high:
        end = min(low + step, high)
        if a[i + low : i + end] == b[j + low : j + end]:
            low, step = end, step * 2
        elif end - low == 1:
            break
        else:
            high, step = end - 1, max(1, (end - low) // 2)
    return low


class Terminal:
    """What is known of one text: a number that depends on the text alone, the smallest id, and per group
    of documents their count and the count of those with that id."""

    __slots__ = ("kind", "least", "groups")

    def __init__(self, kind: int, least: int, groups: dict[str, tuple[int, int]]):
        self.kind, self.least, self.groups = kind, least, groups

    def add(self, least: int, groups: dict[str, tuple[int, int]]) -> None:
        if least < self.least:
            self.least, self.groups, least, groups = least, groups, self.least, self.groups
        same = least == self.least
        for g, (n, first) in groups.items():
            a, b = self.groups.get(g, (0, 0))
            self.groups[g] = (a + n, b + first if same else b)


class RadixTrie:
    """A compressed trie of byte strings. A node's edge is a stretch of one of the texts put in; only
    where two texts part is there a node, so an insertion takes a step per fork and not per byte."""

    __slots__ = ("root", "bytes")

    def __init__(self):
        self.root = [b"", 0, 0, {}, None]  # text, start and end of the edge, children by byte, terminal
        self.bytes = 0

    def put(self, text: bytes, kind: int, least: int, groups: dict[str, tuple[int, int]]) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[3].get(text[at])
            if child is None:
                node[3][text[at]] = [text, at, len(text), {}, Terminal(kind, least, groups)]
                self.bytes += len(text) - at + 64
                return
            held, start, end, *_ = child
            same = _shared(text, at, held, start, end)
            at += same
            if same < end - start:  # the edge forks here
                upper = [held, start, start + same, {held[start + same]: child}, None]
                child[1] = start + same
                node[3][held[start]] = upper
                child = upper
            node = child
        if node[4] is None:
            node[4] = Terminal(kind, least, groups)
        else:
            node[4].add(least, groups)

    def terminals(self) -> Iterator[tuple[bytes, Terminal]]:
        """Texts with what is known of them. A text is read off its terminal's own edge: the text that
        edge was cut from starts with all of it."""
        waiting = [self.root]
        while waiting:
            held, _, end, children, terminal = waiting.pop()
            if terminal is not None:
                yield held[:end], terminal
            waiting.extend(children.values())


def _rows(found: list[tuple[bytes, Terminal]], marked: bool) -> pa.RecordBatch:
    groups = [sorted(t.groups.items()) for _, t in found]
    count = pa.list_(pa.int64())
    marks = [pa.array([_marks(x) for x, _ in found], count)] if marked else []
    return pa.record_batch(
        [
            pa.array([x for x, _ in found], pa.binary()).cast(pa.string()),
            pa.array([len(x) for x, _ in found], pa.int64()),
            pa.array([t.kind for _, t in found], pa.int32()),
            pa.array([t.least for _, t in found], pa.int64()),
            pa.array([[k for k, _ in g] for g in groups], pa.list_(pa.string())),
            pa.array([[v[0] for _, v in g] for g in groups], count),
            pa.array([[v[1] for _, v in g] for g in groups], count),
            *marks,
        ],
        ["text", "n_bytes", "kind", "least", "groups", "docs", "firsts", "marks"][: 7 + marked],
    )


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, int, dict[str, tuple[int, int]]]]:
    text = batch.column("text").cast(pa.binary()).to_pylist()
    rest = [batch.column(c).to_pylist() for c in ("kind", "least", "groups", "docs", "firsts")]
    for x, kind, least, groups, docs, firsts in zip(text, *rest):
        yield x, kind, least, dict(zip(groups, zip(docs, firsts)))


def local_terminals(docs: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """The distinct texts of each task (``MARKED``), from rows of text, ``kind`` (a number that depends on the text
    alone), ``id`` and ``groups_key``. A task whose texts outgrow ``limit`` hands its trie on and starts
    another, so a text may come out of a task more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RadixTrie()
        for batch in batches:
            text = batch.column("text").cast(pa.binary())
            columns = [batch.column(c).to_pylist() for c in ("kind", "id", "groups_key")]
            for x, kind, doc, key in zip(text, *columns):
                trie.put(x.as_py(), kind, doc, {key: (1, 1)})
                if trie.bytes > limit:
                    yield from _handed_on(trie, True)
                    trie = RadixTrie()
        yield from _handed_on(trie, True)

    return docs.select("text", "kind", "id", "groups_key").mapInArrow(run, MARKED)


def _handed_on(trie: RadixTrie, marked: bool, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    some: list = []
    size = 0
    for one in trie.terminals():
        some.append(one)
        size += len(one[0])
        if size > limit:
            yield _rows(some, marked)
            some, size = [], 0
    if some:
        yield _rows(some, marked)


def _marks(text: bytes) -> list[int]:
    """Hashes of the text's prefixes of 4, 16, 64, ... bytes that are shorter than the text."""
    import xxhash

    out, size = [], FIRST_PREFIX
    while size < len(text):
        out.append(xxhash.xxh64_intdigest(text[:size]) - (1 << 63))
        size *= 4
    return out


def prefix_lengths(texts: DataFrame, max_bytes: int, max_texts: int) -> DataFrame:
    """The texts with ``prefix_length``: the first of 4, 16, 64, ... bytes under which no more than
    ``max_bytes`` bytes and ``max_texts`` texts share the prefix, or that holds the whole text.

    Prefixes of all lengths are counted at once, by hash (a clash only lengthens another prefix). At most
    total / max_bytes + total / max_texts of them are crowded at a level; their hashes go to the tasks.
    """
    counts = texts.select("n_bytes", F.posexplode("marks").alias("level", "mark")).groupBy("level", "mark").agg(
        F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")
    )
    crowded = counts.filter((F.col("b") > max_bytes) | (F.col("n") > max_texts)).select("level", "mark").toPandas()
    levels = [np.sort(g["mark"].to_numpy()) for _, g in crowded.groupby("level")]
    known = texts.sparkSession.sparkContext.broadcast(levels)

    def settled(marks: pd.Series) -> pd.Series:
        sets = known.value
        level = np.zeros(len(marks), np.int64)
        for i, own in enumerate(marks):
            k = 0
            while k < min(len(own), len(sets)):
                at = np.searchsorted(sets[k], own[k])
                if at == len(sets[k]) or sets[k][at] != own[k]:
                    break
                k += 1
            level[i] = k
        return pd.Series(FIRST_PREFIX * 4**level)

    return texts.withColumn("prefix_length", F.pandas_udf(settled, "bigint")("marks").cast("int")).drop("marks")


def merged_terminals(
    local: DataFrame, limit: int = TRIE_BYTES, pieces: int = PIECES, texts: int = PREFIX_TEXTS
) -> DataFrame:
    """One row per distinct text, from the stored rows of ``local_terminals``.

    Partitions are ranges of prefixes, so rows of one text meet. They come sorted by text: when a trie
    outgrows ``limit``, all its terminals but the last text's are final.
    """
    total = local.agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")).first()
    size, rows = total.b or 0, total.n
    cut = prefix_lengths(local, max(PREFIX_BYTES, size // pieces), max(texts, rows // pieces))
    parts = max(1, -(-size // max(TASK_BYTES, size // pieces)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = RadixTrie(), None
        for batch in batches:
            for x, kind, least, groups in _entries(batch):
                if trie.bytes > limit and x != last:
                    yield from _handed_on(trie, False)
                    trie = RadixTrie()
                trie.put(x, kind, least, groups)
                last = x
        yield from _handed_on(trie, False)

    by_prefix = cut.repartitionByRange(parts, F.expr("substring(cast(text as binary), 1, prefix_length)"))
    return by_prefix.drop("prefix_length").sortWithinPartitions("text").mapInArrow(run, TERMINALS)


def text_groups(rows: DataFrame) -> DataFrame:
    """Distinct texts with their smallest id and counts (``TERMINALS``), from rows of text, kind, id and
    groups_key. A null id ranks after all others."""
    keyed = rows.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "kind",
        F.coalesce("id", F.lit(NO_ID)).alias("id"), "groups_key",
    )
    return merged_terminals(stored(local_terminals(keyed), "local-terminals"))
