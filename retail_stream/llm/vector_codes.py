"""Product codes of vectors: a codebook for each part of a vector, fitted by active-entry Lloyd rounds.

Every part keeps its entry and the exact squared distance to it from one round to the next. In the next
round a part whose entry did not move is compared with the moved entries only, against the stored
distance: no entry that stayed can have become nearer. Other parts are compared with the whole codebook.
Codebooks are a few thousand integers whatever the table holds; they alone travel through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_stream.llm.common import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Numbers a task works on at a time.
BLOCK = 1 << 20
# Label sums go to the rows up to this many bytes; beyond it both are shuffled.
BROADCAST_BYTES = 32 << 20
LABEL_BYTES = 64


def _limit(dim: int) -> int:
    """Integers up to this size have a squared distance over ``dim`` components below 2^62."""
    return math.isqrt((1 << 62) // dim) // 2


def _scaled(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of integers floor(SCALE * x)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    edge = _limit(dim)
    return np.clip(np.floor(flat * SCALE), -edge, edge).astype(np.int64).reshape(-1, dim)


def _ints(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), kind))


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * x.shape[1] < 1 << 53:  # whole numbers that doubles hold
        a, b = x.astype(np.float64), entries.astype(np.float64)
        found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        return found.astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], 1)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each row's nearest entry, the lower index on ties."""
    found = distances(x, entries)
    at = found.argmin(1)
    return at, found[np.arange(len(x)), at]


def renewed(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, dist: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` from the indexes and distances before the entries marked ``moved`` were replaced."""
    at, dist = at.copy(), dist.copy()
    lost = moved[at]
    if lost.any():
        at[lost], dist[lost] = nearest(x[lost], entries)
    active = np.flatnonzero(moved)
    fixed = np.flatnonzero(~lost)
    if len(active) and len(fixed):
        best, value = nearest(x[fixed], entries[active])
        best = active[best]
        won = (value < dist[fixed]) | ((value == dist[fixed]) & (best < at[fixed]))
        at[fixed[won]], dist[fixed[won]] = best[won], value[won]
    return at, dist


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, BLOCK // dim)
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def whole_vectors(vectors: DataFrame, parts: int = PARTS) -> tuple[DataFrame, int]:
    """vec_id, embedding and label of the vectors that can be coded, and their length.

    Null vectors and those with null or non-finite components are left out. All others have the length
    most of them have among the multiples of ``parts``, the shorter on ties; rows of another length have
    no equal parts in common with them and are left out too.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select("vec_id", "embedding", "label").filter(F.col("embedding").isNotNull() & fine)
    size = F.size("embedding")
    sizes = rows.groupBy(size.alias("dim")).count().filter((F.col("dim") > 0) & (F.col("dim") % parts == 0))
    top = sizes.orderBy(F.desc("count"), "dim").first()
    dim = top.dim if top else parts
    return rows.filter(size == dim), dim


def first_books(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """part, entry, component: the parts of the vectors of the smallest ids. Of rows of one id the smallest
    vector counts; a null id ranks after all others. Every task hands on its own smallest ids only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict = {}
        for batch in batches:
            ids = batch.column("vec_id").to_pylist()
            rank = [(i is None, i or 0) for i in ids]
            edge = max(least) if len(least) >= entries else None
            close = [n for n, r in enumerate(rank) if edge is None or r <= edge]
            if not close:
                continue
            found = _scaled(batch.column("embedding").take(pa.array(close, pa.int64())), dim)
            for n, v in zip(close, found.tolist()):
                least[rank[n]] = min(least.get(rank[n], v), v)
            least = {r: least[r] for r in sorted(least)[:entries]}
        if least:
            yield pa.record_batch(
                [pa.array([r[0] for r in least]), pa.array([r[1] for r in least], pa.int64()),
                 pa.array(list(least.values()), pa.list_(pa.int64()))],
                ["none", "id", "vector"],
            )

    slim = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    found = slim.mapInArrow(run, "none boolean, id bigint, vector array<bigint>")
    seeds = found.groupBy("none", "id").agg(F.min("vector").alias("vector")).orderBy("none", "id").limit(entries)
    books = np.array([r.vector for r in seeds.collect()], np.int64).reshape(-1, parts, dim // parts)
    return books.transpose(1, 0, 2).copy()


def _state_schema(rows: DataFrame) -> str:
    label = rows.schema["label"].dataType.simpleString()
    return f"vec_id bigint, label {label}, vector array<int>, code array<int>, dist array<bigint>"


def _state(batch: pa.RecordBatch, x: np.ndarray, at: np.ndarray, dist: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [batch.column("vec_id"), batch.column("label"), _lists(x, pa.int32()), _lists(at, pa.int32()),
         _lists(dist, pa.int64())],
        ["vec_id", "label", "vector", "code", "dist"],
    )


def assigned(rows: DataFrame, dim: int, books: np.ndarray) -> DataFrame:
    """Every part's nearest entry and distance, by a full scan of the codebooks."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, dim):
            x = _scaled(batch.column("embedding"), dim)
            found = [nearest(x[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
            yield _state(batch, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1))

    slim = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    return slim.mapInArrow(run, _state_schema(rows))


def reassigned(state: DataFrame, dim: int, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    """The state after the entries marked ``moved`` were replaced by those of ``books``."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, dim):
            x = _ints(batch.column("vector"), dim)
            at, dist = _ints(batch.column("code"), parts), _ints(batch.column("dist"), parts)
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                at[:, p], dist[:, p] = renewed(part, books[p], moved[p], at[:, p], dist[:, p])
            yield _state(batch, x, at, dist)

    return state.mapInArrow(run, _state_schema(state))


def updated(state: DataFrame, dim: int, books: np.ndarray) -> np.ndarray:
    """Codebooks with each entry replaced by floor(sum / count) of its parts; unused entries stay.

    A task adds its parts up and hands on one number per component of a codebook.
    """
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in _blocks(batches, dim):
            x, at = _ints(batch.column("vector"), dim), _ints(batch.column("code"), parts)
            for p in range(parts):
                np.add.at(total[p], at[:, p], x[:, p * width : (p + 1) * width])
                count[p] += np.bincount(at[:, p], minlength=entries)
        p, e = np.nonzero(count)
        if len(p):
            slot = np.repeat((p * entries + e) * width, width) + np.tile(np.arange(width), len(p))
            yield pa.record_batch(
                [pa.array(slot), pa.array(total[p, e].ravel()), pa.array(np.repeat(count[p, e], width))],
                ["slot", "total", "n"],
            )

    sums = state.select("vector", "code").mapInArrow(run, "slot bigint, total bigint, n bigint")
    exact = sums.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    new = books.copy()
    for r in exact.collect():  # at most as many rows as the codebooks have numbers
        new.reshape(-1)[r.slot] = int(r.total) // r.n
    return new


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _code_text() -> Column:
    return F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """The code of every vector, and the final codebooks (part, entry, component).

    Columns: vec_id, label, code (two hex digits a part), error (squared distances summed) and label_error
    (errors summed over rows of equal labels, null labels together). One row per vector that can be coded
    (see ``whole_vectors``), repeated and null ids included. Fewer ids than ``entries`` make smaller
    codebooks; equal entries and equal distances go to the lower index; an empty table gives no rows and
    empty codebooks. Components count as at most ``_limit`` in size, 2^27 for 64 of them, so that
    distances fit a long. Other columns of ``vectors`` are not looked at.
    """
    if entries > 256:
        raise ValueError("an entry's index has two hex digits")
    rows, dim = whole_vectors(vectors, parts)
    books = first_books(rows, dim, parts, entries)
    state = assigned(rows, dim, books)
    for _ in range(rounds):
        state = stored(state, "vector-state")
        new = updated(state, dim, books)
        state = reassigned(state, dim, new, (new != books).any(2))
        books = new
    error = F.aggregate("dist", F.lit(0).cast("bigint"), lambda s, d: s + d)
    coded = stored(state.select("vec_id", "label", _code_text().alias("code"), error.alias("error")), "vector-codes")
    sums = stored(
        coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors"
    )
    if sums.count() * LABEL_BYTES <= BROADCAST_BYTES:
        sums = F.broadcast(sums)
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left")
    return joined.select("vec_id", "label", "code", "error", "label_error"), books


def digest(found: tuple[DataFrame, np.ndarray]) -> DataFrame:
    """The rows beside the digest of the codebooks."""
    coded, books = found
    return coded.drop("label").withColumn("codebooks_sha256", F.lit(books_digest(books)))
