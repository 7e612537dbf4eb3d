"""Removal of bytes in 100-byte strings that start earlier in the corpus, by suffix sorting.

Strings that may repeat are dealt into shards by minimiser, so equal ones share a shard. A shard's text
is suffix sorted by external induction (``induced_sort``); neighbours that share 100 bytes are equal
strings, and the earliest of them stays. A shard's text and ranks are arrays in memory, its queues lie on
disk beyond a number of tuples; shards of the size used here stay below that number. Only positions, not
shards, are joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_stream.llm import induced_sort, superkmers
from retail_stream.llm.common import bounds, whole_groups

WINDOW = 100
GRAM = 24
SHARD_BYTES = 2 << 20
BYTE_HASHES = superkmers.mixed(np.arange(1, 257, dtype=np.uint64) * superkmers.P)


def _split(texts: pa.Array):
    data = texts.cast(pa.binary())
    ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    raw = data.buffers()[2]
    units = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else np.empty(0, np.uint8)
    return BYTE_HASHES[units], ends - ends[0]


BYTES = superkmers.Units(
    WINDOW, GRAM, _split, lambda data: data, lambda data, a, b: data[a:b],
    lambda packed, n: [packed[o : o + WINDOW] for o in range(n)],
)


def first_places(rows: pd.DataFrame, base: int = induced_sort.BASE, limit: int = induced_sort.IN_MEMORY) -> pd.DataFrame:
    """RUNS of one shard: for every 100-byte string the first place that it has in the shard.

    Symbols are bytes plus one, which UTF-8 keeps below 256, and strings are parted by 0.
    """
    packed = rows["packed"].tolist()
    n = rows["n"].to_numpy(np.int64)
    sizes = np.array([len(p) for p in packed], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\0".join(packed) + b"\0", np.uint8) + np.uint8(1)
    text[begin + sizes] = 0
    total = int(n.sum())
    owner = np.repeat(np.arange(len(n)), n)
    offset = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    number = np.full(len(text), -1, np.int64)
    number[np.repeat(begin, n) + offset] = np.arange(total)
    doc = rows["doc"].to_numpy(np.int64)[owner]
    version = rows["version"].to_numpy(np.int64)[owner]
    place = rows["place"].to_numpy(np.int64)[owner] + offset
    first = np.arange(total)
    for part in induced_sort.suffixes(text, WINDOW, base, limit):
        string = np.cumsum(part[:, 1] < WINDOW)
        window = number[part[:, 0]]
        real = window >= 0
        string, window = string[real], window[real]
        order = np.lexsort((place[window], version[window], doc[window], string))
        string, window = string[order], window[order]
        head = np.ones(len(string), bool)
        head[1:] = string[1:] != string[:-1]
        at = np.flatnonzero(head)
        first[window] = np.repeat(window[at], np.diff([*at, len(window)]))
    first_doc, first_version, first_place = doc[first], version[first], place[first]
    new = np.ones(total, bool)
    new[1:] = (owner[1:] != owner[:-1]) | (first_doc[1:] != first_doc[:-1]) | (np.diff(first_place) != 1)
    new[1:] |= first_version[1:] != first_version[:-1]
    at = np.flatnonzero(new)
    return pd.DataFrame({
        "m": rows["m"].to_numpy()[owner[at]], "sk": rows["sk"].to_numpy()[owner[at]], "o": offset[at],
        "n": np.diff([*at, total]), "first_doc": first_doc[at], "first_version": first_version[at],
        "first_place": first_place[at],
    })


def settler(shard_bytes: int = SHARD_BYTES, base: int = induced_sort.BASE, limit: int = induced_sort.IN_MEMORY):
    def settle(strings: DataFrame) -> DataFrame:
        size = strings.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
        shards = max(1, -(-size // shard_bytes))
        dealt = strings.withColumn("shard", F.pmod(F.xxhash64("m"), F.lit(shards)))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in whole_groups(frames, ["shard"]):
                for a, b in bounds(frame, ["shard"]):
                    yield first_places(frame.iloc[a:b], base, limit)

        return dealt.repartition("shard").sortWithinPartitions("shard").mapInPandas(run, superkmers.RUNS)

    return settle


def remove_repeats(
    docs: DataFrame, hot: int = superkmers.HOT, shard_bytes: int = SHARD_BYTES,
    base: int = induced_sort.BASE, limit: int = induced_sort.IN_MEMORY,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left).

    One row per input row; texts are taken as UTF-8. Removed are the bytes of 100-byte strings that
    also start in a smaller doc_id, or earlier in the same document; a null id ranks after all others.
    Rows that repeat id and text are one document; different texts of one id are ordered by a hash.
    Null, empty or short texts lose nothing. ``kept`` may cut a character in two, so it is binary.
    """
    texts = superkmers.keyed(docs)
    spans = superkmers.removed_windows(texts, BYTES, settler(shard_bytes, base, limit), same_doc=True, hot=hot)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = superkmers.unpacker()
        for frame in frames:
            out = []
            for doc, none, packed, found in zip(frame["doc"], frame["none"], frame["packed"], frame["spans"]):
                data = np.frombuffer(unpack(packed), np.uint8)
                gone = superkmers.covered(len(data), found, WINDOW)
                starts = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
                out.append((None if none else doc, len(data), int(gone.sum()), starts, data[~gone].tobytes()))
            made = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
            yield made.assign(doc_id=pd.array([r[0] for r in out], "Int64"))

    return superkmers.with_spans(texts, spans).mapInPandas(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
