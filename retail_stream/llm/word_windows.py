"""Removal of words in 50-word windows that also start in an earlier document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_stream.llm import superkmers
from retail_stream.llm.common import bounds, whole_groups

WINDOW = 50
GRAM = 20


def _split(texts: pa.Array):
    import xxhash

    words = [x.encode().split() for x in texts.to_pylist()]
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=offsets[1:])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x) for w in words for x in w), np.uint64, offsets[-1]), offsets


def _windows(packed: bytes, n: int, window: int = WINDOW) -> list[bytes]:
    words = packed.split(b" ")
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    return [packed[ends[o] - len(words[o]) : ends[o + window - 1]] for o in range(n)]


WORDS = superkmers.Units(
    WINDOW, GRAM, _split, lambda data: data.split(), lambda words, a, b: b" ".join(words[a:b]), _windows
)


def settle(strings: DataFrame) -> DataFrame:
    """First places by sorting: a bucket's windows are sorted as strings, equal ones lie together and
    the first of them comes first. Buckets are bounded, and larger partitions spill in Spark's sort."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["m"]):
            out = []
            for a, b in bounds(frame, ["m"]):
                rows = list(frame.iloc[a:b].itertuples(index=False))
                ordered = sorted(
                    (w, row.doc, row.version, row.place + o, i, o)
                    for i, row in enumerate(rows) for o, w in enumerate(_windows(row.packed, row.n))
                )
                first = [[None] * row.n for row in rows]
                window = None
                for w, *place, i, o in ordered:
                    if w != window:
                        window, least = w, tuple(place)
                    first[i][o] = least
                for row, f in zip(rows, first):
                    out.extend((row.m, row.sk, *r) for r in superkmers.runs(f))
            yield pd.DataFrame(out, columns=["m", "sk", "o", "n", "first_doc", "first_version", "first_place"])

    return strings.repartition("m").sortWithinPartitions("m").mapInPandas(run, superkmers.RUNS)


def remove_repeats(docs: DataFrame, hot: int = superkmers.HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space).

    One row per input row. Words are runs of anything but space and \\t to \\r, unchanged. Removed are
    the words of windows whose words also start in a document of smaller doc_id; a null id ranks after
    all others, rows of equal id do not affect each other. Null, empty or short texts lose nothing.
    """
    texts = superkmers.keyed(docs)
    spans = superkmers.removed_windows(texts, WORDS, settle, same_doc=False, hot=hot)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = superkmers.unpacker()
        for frame in frames:
            out = []
            for doc, none, packed, found in zip(frame["doc"], frame["none"], frame["packed"], frame["spans"]):
                words = unpack(packed).split()
                gone = superkmers.covered(len(words), found, WINDOW)
                left = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                out.append((None if none else doc, len(words), int(gone.sum()), b" ".join(left).decode()))
            made = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
            yield made.assign(doc_id=pd.array([r[0] for r in out], "Int64"))

    return superkmers.with_spans(texts, spans).mapInPandas(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    )


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


