"""Windows that occur elsewhere, found by super-k-mer partitioning.

A text is a row of units (words or bytes). The minimiser of a window is the m-gram of least hash in it,
the leftmost of equals; consecutive windows with the same one form a super-k-mer and travel together. Equal windows
have equal minimisers, so they meet in one bucket. The steps, each a Spark job:

1. One scan gives every super-k-mer's minimiser, hash and place. Minimisers met once drop out.
2. Equal super-k-mers are reduced to their first place: copies of a text, however many, become one.
3. Only where a minimiser has several different super-k-mers are their units needed. They are cut from
   the texts and packed as one string each, and an operator's own method finds the first place of
   every window in a bucket.
4. First places are joined back to all places, which gives the windows that occur earlier.

What a step shuffles or stores is deleted when the steps that read it have ended, so the disk holds a part of
it at a time.

A minimiser frequent in a task's batch is known to repeat: one row stands for the batch where rows are
counted, the others pass by another route, so no reducer gets all rows of a hot one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_stream.llm.common import chunks, doc_key, kept, no_old_shuffles, stored

# Ids met more than once go to the texts up to this many bytes; beyond it both are shuffled.
BROADCAST_BYTES = 32 << 20
ID_BYTES = 16
# A minimiser with more different super-k-mers than this is settled by window hashes over many tasks.
HOT = 2000
RUNS = "m bigint, sk bigint, o int, n int, first_doc bigint, first_version bigint, first_place bigint"
PLACES = "m bigint, sk bigint, doc bigint, version bigint, at bigint"
P = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Units:
    """``split`` gives the unit hashes of a batch of texts and the offsets of the texts in them;
    ``prepare`` readies a text's bytes, ``cut`` packs units [a, b) of it, ``windows`` are the windows of a packed string."""

    window: int
    gram: int
    split: Callable
    prepare: Callable
    cut: Callable
    windows: Callable


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(k: int) -> np.uint64:
    return np.uint64(pow(int(P), k, 1 << 64))


def grams(units: np.ndarray, m: int) -> np.ndarray:
    """Polynomial hashes of all m-grams, by doubling."""
    out, have, size, level = None, 0, 1, units
    while True:
        if m & size:
            if out is None:
                out, have = level, size
            else:
                n = len(units) - have - size + 1
                out, have = out[:n] * _power(size) + level[have : have + n], have + size
        if size * 2 > m:
            return mixed(out)
        n = len(units) - 2 * size + 1
        level, size = level[:n] * _power(size) + level[size : size + n], size * 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def super_kmers(units: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """text, position, windows, minimiser and hash of every super-k-mer of a batch of texts."""
    counts = np.maximum(np.diff(offsets) - window + 1, 0)
    total = int(counts.sum())
    if not total:
        return (np.empty(0, np.int64),) * 5
    hashes = grams(units, gram)
    # Half of the hash and the position: the leftmost of the least, the same in equal windows.
    low = np.uint64(32)
    least = sliding_min(((hashes >> low) << low) | np.arange(len(hashes), dtype=np.uint64), window - gram + 1)
    before = np.cumsum(counts) - counts
    start = np.repeat(offsets[:-1] - before, counts) + np.arange(total)
    which = least[start]
    new = np.ones(total, bool)
    new[1:] = which[1:] != which[:-1]
    new[before[counts > 0]] = True
    at = np.flatnonzero(new)
    n = np.diff([*at, total])
    minimiser = hashes[which[at] & np.uint64(0xFFFFFFFF)]
    begin = start[at]
    powers = np.ones(len(units) + 1, np.uint64)
    powers[1:] = np.cumprod(np.full(len(units), P))
    inverse = np.ones(len(units) + 1, np.uint64)
    inverse[1:] = np.cumprod(np.full(len(units), np.uint64(pow(int(P), -1, 1 << 64))))
    prefix = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers[:-1], out=prefix[1:])
    whole = (prefix[begin + n + window - 1] - prefix[begin]) * inverse[begin]
    whole = mixed(whole + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    text = np.searchsorted(offsets, begin, side="right") - 1
    return text, begin - offsets[text], n, minimiser.view(np.int64), whole.view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, doc, version, text: a null text is empty, a null id ranks last (with 2^63-1).

    Rows of one id stay apart by version, the 64-bit hash of their text; the version of a row whose id is
    met once is 0, which costs the joins nothing.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), doc_key().alias("doc"), text.alias("text"))
    again = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(F.col("doc").alias("again"))
    again = stored(again, "repeated-ids")
    n = again.count()
    if not n:
        return rows.select("doc_id", "doc", F.lit(0).cast("bigint").alias("version"), "text")
    if n * ID_BYTES <= BROADCAST_BYTES:
        again = F.broadcast(again)
    version = F.when(F.col("again").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0))
    joined = rows.join(again, F.col("doc") == F.col("again"), "left")
    return joined.select("doc_id", "doc", version.cast("bigint").alias("version"), "text")


def compressed(texts: DataFrame) -> DataFrame:
    """doc_id, doc, version, packed: the UTF-8 text compressed, for the joins that move whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            packed = pa.array([packer.compress(x.as_buffer()) for x in texts], pa.binary())
            names = ["doc_id", "doc", "version"]
            yield pa.record_batch([*[batch.column(c) for c in names], packed], [*names, "packed"])

    return texts.mapInArrow(run, "doc_id bigint, doc bigint, version bigint, packed binary")


def unpacker() -> Callable[[bytes], bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def _routes(m: np.ndarray, at: np.ndarray) -> np.ndarray:
    """0: met once in this batch; -1: stands for the rows of its minimiser in this batch; else a number
    that spreads the other rows."""
    order = np.argsort(m, kind="stable")
    s = m[order]
    first = np.ones(len(s), bool)
    first[1:] = s[1:] != s[:-1]
    more = np.zeros(len(s), bool)
    more[:-1] = s[1:] == s[:-1]
    spread = 1 + (mixed(at[order].view(np.uint64)) >> np.uint64(44)).astype(np.int32)
    routes = np.empty(len(s), np.int32)
    routes[order] = np.where(first, np.where(more, -1, 0), spread)
    return routes


def repeated(texts: DataFrame, units: Units) -> DataFrame:
    """PLACES of the super-k-mers whose minimiser occurs more than once; at is position << 8 | n,
    and n windows are fewer than the window is long (at most 255)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for part in chunks([batch], "text", 1 << 19):
                hashes, offsets = units.split(part.column("text"))
                text, position, n, m, sk = super_kmers(hashes, offsets, units.window, units.gram)
                doc, version = (part.column(c).to_numpy(zero_copy_only=False)[text] for c in ("doc", "version"))
                parts.append((m, sk, doc, version, (position << 8) | n))
            m, sk, doc, version, at = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 5
            routes = pa.array(_routes(m, at ^ doc ^ version), pa.int32())
            yield pa.record_batch(
                [*[pa.array(x, pa.int64()) for x in (m, sk, doc, version, at)], routes],
                ["m", "sk", "doc", "version", "at", "route"],
            )

    def more_than_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if last is None else pa.concat_batches([last, batch])
            m, route = rows.column("m").to_numpy(), rows.column("route").to_numpy()
            same = m[1:] == m[:-1]
            keep = route != 0
            keep[1:] |= same
            keep[:-1] |= same & (route[1:] <= 0)
            keep[0] |= before is not None and m[0] == before
            if len(m) > 1:
                yield rows.slice(0, len(m) - 1).filter(pa.array(keep[:-1])).drop_columns(["route"])
                before = m[-2]
            last = rows.slice(len(m) - 1)
        if last is not None:
            kept = last.column("route")[0].as_py() != 0 or last.column("m")[0].as_py() == before
            yield last.filter(pa.array([kept])).drop_columns(["route"])

    rows = texts.select("doc", "version", "text").mapInArrow(scan, f"{PLACES}, route int")
    met = rows.repartition("m", F.greatest("route", F.lit(0))).sortWithinPartitions("m", "route")
    return met.mapInArrow(more_than_once, PLACES)


def packed_strings(texts: DataFrame, wanted: DataFrame, units: Units) -> DataFrame:
    """m, sk, doc, version, place, n, packed: the units of the wanted super-k-mers, cut from their texts."""
    lists = wanted.groupBy("doc", "version").agg(F.collect_list(F.struct("m", "sk", "at")).alias("items"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = unpacker()
        for frame in frames:
            out = []
            for doc, version, packed, items in zip(frame["doc"], frame["version"], frame["packed"], frame["items"]):
                ready = units.prepare(unpack(packed))
                for x in items:
                    a, n = x["at"] >> 8, x["at"] & 255
                    out.append((x["m"], x["sk"], doc, version, a, n, units.cut(ready, a, a + n + units.window - 1)))
            yield pd.DataFrame(out, columns=["m", "sk", "doc", "version", "place", "n", "packed"])

    joined = compressed(texts).join(lists, ["doc", "version"]).select("doc", "version", "packed", "items")
    return joined.mapInPandas(
        cut, "m bigint, sk bigint, doc bigint, version bigint, place bigint, n int, packed binary"
    )


def runs(first: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
    """(o, n, doc, version, place) of the runs of windows whose first places follow one another."""
    o = 0
    for i in range(1, len(first) + 1):
        if i == len(first) or first[i][:2] != first[o][:2] or first[i][2] - first[o][2] != i - o:
            yield o, i - o, *first[o]
            o = i


def _by_hash(strings: DataFrame, units: Units) -> tuple[DataFrame, Callable[[], None]]:
    """First places in hot buckets, by 128-bit window hashes: as many tasks as there is data; and what deletes
    the rows they are read from."""

    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                for o, w in enumerate(units.windows(row.packed, row.n)):
                    out.append((row.m, row.sk, o, blake2b(w, digest_size=16).digest(), row.doc, row.version, row.place + o))
            yield pd.DataFrame(out, columns=["m", "sk", "o", "w", "doc", "version", "place"])

    rows, drop = kept(
        strings.mapInPandas(
            explode, "m bigint, sk bigint, o int, w binary, doc bigint, version bigint, place bigint"
        ), "hot-windows"
    )
    first = rows.groupBy("w").agg(F.min(F.struct("doc", "version", "place")).alias("f"))
    found = rows.join(first, "w").select(
        "m", "sk", "o", F.lit(1).alias("n"), F.col("f.doc").alias("first_doc"),
        F.col("f.version").alias("first_version"), F.col("f.place").alias("first_place"),
    )
    return found, drop


def removed_windows(texts: DataFrame, units: Units, settle: Callable[[DataFrame], DataFrame], same_doc: bool, hot: int = HOT) -> DataFrame:
    """doc, version, spans: (start, n) runs of windows of ``keyed`` texts that occur earlier: in a smaller doc, or with
    ``same_doc`` also earlier in the same one. ``settle`` turns packed strings of buckets of at most
    ``hot`` different super-k-mers into rows of RUNS."""
    with no_old_shuffles(texts.sparkSession):
        return _removed_windows(texts, units, settle, same_doc, hot)


def _removed_windows(texts: DataFrame, units: Units, settle: Callable[[DataFrame], DataFrame], same_doc: bool, hot: int) -> DataFrame:
    places, drop_places = kept(repeated(texts, units), "super-kmers")
    first = places.groupBy("m", "sk").agg(F.min(F.struct("doc", "version", "at")).alias("f")).select("m", "sk", "f.*")
    first, drop_first = kept(first, "first-places")
    counts = first.groupBy("m").agg(F.count(F.lit(1)).alias("different"))
    first = first.join(counts, "m")
    alone = first.filter("different = 1").select(
        "m", "sk", F.lit(0).alias("o"), F.col("at").bitwiseAND(255).cast("int").alias("n"),
        F.col("doc").alias("first_doc"), F.col("version").alias("first_version"),
        F.shiftright("at", 8).alias("first_place"),
    )
    several = first.filter("different > 1")
    strings, drop_strings = kept(packed_strings(texts, several.select("m", "sk", "doc", "version", "at"), units), "packed")
    large = counts.filter(F.col("different") > hot).select("m")
    usual = settle(strings.join(large, "m", "left_anti"))
    hashed, drop_hashed = _by_hash(strings.join(large, "m", "left_semi"), units)
    known, drop_known = kept(alone.unionByName(usual).unionByName(hashed), "known-places")
    for drop in (drop_first, drop_strings, drop_hashed):
        drop()
    place = F.shiftright("at", 8) + F.col("o")
    earlier = F.col("first_doc") < F.col("doc")
    if same_doc:
        before = (F.col("first_version") == F.col("version")) & (F.col("first_place") < place)
        before |= F.col("first_version") < F.col("version")
        earlier |= (F.col("first_doc") == F.col("doc")) & before
    spans = (
        places.join(known, ["m", "sk"])
        .filter(earlier)
        .select("doc", "version", F.struct(place.alias("start"), "n").alias("span"))
        .groupBy("doc", "version")
        .agg(F.collect_set("span").alias("spans"))
    )
    spans = stored(spans, "spans")
    drop_places()
    drop_known()
    return spans


def covered(n_units: int, spans, window: int) -> np.ndarray:
    """Which units lie in a window of the spans."""
    change = np.zeros(n_units + 1, np.int64)
    if spans is not None and len(spans):
        start = np.array([s["start"] for s in spans], np.int64)
        n = np.array([s["n"] for s in spans], np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + n + window - 1, -1)
    return np.cumsum(change[:-1]) > 0


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """doc, none (whether the id is null), packed text, spans for every input row."""
    joined = compressed(texts).join(spans, ["doc", "version"], "left")
    return joined.select("doc", F.isnull("doc_id").alias("none"), "packed", "spans")
