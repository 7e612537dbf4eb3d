"""Substring removal against brute force, with hot buckets and rows that share an id."""

import random
from pathlib import Path

import numpy as np
import pytest

import cases
from retail_stream.llm import byte_windows, common, induced_sort, superkmers, word_windows

WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.fixture(params=["given", "hard", "empty"])
def docs(request):
    return {"given": cases.documents, "hard": cases.hard_documents, "empty": list}[request.param]()


@pytest.mark.parametrize("hot", [superkmers.HOT, 1])
def test_word_windows(spark, docs, hot):
    found = word_windows.digest(word_windows.remove_repeats(cases.frame(spark, docs, clash=True), hot))
    assert cases.rows_of(found, *WORDS) == cases.window_dedup(docs)


def test_rows_of_one_id_do_not_affect_each_other(spark):
    base = cases.hard_documents()[0][1]
    docs = [(4, base), (4, "before " + base), (9, base + " after"), (4, base)]
    docs = [(d, t, None, None, None) for d, t in docs]
    found = word_windows.digest(word_windows.remove_repeats(cases.frame(spark, docs)))
    assert cases.rows_of(found, *WORDS) == cases.window_dedup(docs)


def test_hot_minimiser_is_counted_in_one_row_per_batch(spark):
    """Copies of one text: the rows that meet in a reducer are few, and all copies are found."""
    base = cases.hard_documents()[0][1]
    docs = [(i, base, None, None, None) for i in range(3000)]
    places = superkmers.repeated(superkmers.keyed(cases.frame(spark, docs)), word_windows.WORDS)
    per_doc = len({r.m for r in places.filter("doc = 0").collect()})
    assert places.count() >= 3000 * per_doc > 0
    found = word_windows.remove_repeats(cases.frame(spark, docs))
    assert found.filter("n_removed = 300").count() == 2999


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
SMALL_LIMITS = {"hot": 40, "shard_bytes": 3000, "base": 8, "limit": 100}


@pytest.mark.parametrize("limits", [{}, {"hot": 1}, SMALL_LIMITS])
def test_byte_windows(spark, docs, limits):
    if len(docs) > 50:
        docs = docs[:50]  # brute force over every byte
    found = byte_windows.digest(byte_windows.remove_repeats(cases.frame(spark, docs, clash=True), **limits))
    assert cases.rows_of(found, *BYTES) == cases.byte_dedup(docs)


def test_texts_of_one_id_are_whole_documents(spark):
    base = cases.hard_documents()[0][1]
    docs = [(4, base), (4, "before " + base), (4, base)]
    found = byte_windows.remove_repeats(cases.frame(spark, [(*d, None, None, None) for d in docs])).collect()
    size = len(base.encode())
    assert sorted(r.n_bytes - r.n_removed for r in found) in ([0, 0, size + 7], [7, size, size])


@pytest.mark.parametrize("base", [2, 1 << 20])
@pytest.mark.parametrize("limit", [4, 1 << 20])
def test_induced_sort(base, limit):
    rng = random.Random(base + limit)
    for _ in range(60):
        raw = bytes(rng.choices(rng.choice([b"\1\2", b"\1\2\3", b"abcdefgh"]), k=rng.randint(1, 150)))
        if rng.random() < 0.5:
            raw = raw * 2 + b"\0" + raw[:50] + b"\0" + b"x" * rng.randint(1, 130)
        depth = rng.choice([5, 20, 100])
        text = np.frombuffer(raw + b"\0", np.uint8)
        rows = np.concatenate(list(induced_sort.suffixes(text, depth, base, limit))[::-1])
        assert sorted(rows[:, 0].tolist()) == list(range(len(raw)))
        whole = text.tobytes()
        for (p, _), (q, shared) in zip(rows[:-1], rows[1:]):
            a, b = whole[p : p + depth], whole[q : q + depth]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert a <= b and shared == same


@pytest.mark.parametrize("broadcast", [True, False])
def test_versions_that_agree_in_23_bits(spark, monkeypatch, broadcast):
    """Texts without an id, or of one id, whose hashes agree in their lower bits stay apart."""
    if not broadcast:
        monkeypatch.setattr(superkmers, "BROADCAST_BYTES", 0)
    base = cases.hard_documents()[0][1]
    other = " ".join(base.split()[40:140])
    tail = spark.range(40_000).selectExpr(
        f"id", f"concat('{other} ', id) AS text", f"xxhash64(concat('{other} ', id)) & {(1 << 23) - 1} AS low"
    )
    pairs = tail.groupBy("low").agg({"text": "min", "*": "count"}).filter("`count(1)` > 1").collect()
    low = pairs[0].low
    clash = [r.text for r in tail.filter(f"low = {low}").collect()]
    whole = [(1, base), (2, base + " end"), *[(None, t) for t in clash], *[(7, t) for t in clash], (2**63 - 1, other), (2**53 + 1, "few")]
    docs = [(d, t, None, None, None) for d, t in whole]
    found = word_windows.digest(word_windows.remove_repeats(cases.frame(spark, docs)))
    want = cases.window_dedup([d for d in docs])
    assert cases.rows_of(found, *WORDS) == want
    got = byte_windows.remove_repeats(cases.frame(spark, docs)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d[0]) for d in docs)
    assert all(r.n_removed >= len(other) for r in got if r.doc_id in (None, 7))


def test_what_steps_store_and_shuffle_is_deleted_when_read(spark, monkeypatch):
    paths, scratch = [], common.scratch_dir

    def noted(*args):
        paths.append(scratch(*args))
        return paths[-1]

    monkeypatch.setattr(common, "scratch_dir", noted)
    before = spark.conf.get(common.SHUFFLE_CLEANUP, None)
    docs = cases.hard_documents()[:20]
    found = byte_windows.digest(byte_windows.remove_repeats(cases.frame(spark, docs), **SMALL_LIMITS))
    left = {Path(p).name.rpartition("-")[0] for p in paths if Path(p).exists()}
    assert left == {"repeated-ids", "spans"} and len(paths) == 7
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) == before
    assert cases.rows_of(found, *BYTES) == cases.byte_dedup(docs)
