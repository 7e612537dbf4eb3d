"""The word model against its definition, and that its tables are joined and not sent whole."""

import math
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from retail_stream.llm import perplexity, word_model

TEXTS = [t for _, t, *_ in cases.documents()[:120] if t]


def words(text):
    found = word_model.WORD.findall(text.lower())
    return ["0" if w[0].isdecimal() else w for w in found]


def kneser_ney(texts):
    """Negative log probability of a text by interpolated modified Kneser-Ney pairs, from its definition."""
    pairs = Counter(p for t in texts for w in [words(t)] for p in zip(["<", *w], [*w, ">"]))
    follows = Counter(c for _, c in pairs)
    levels = []
    for grams in (pairs, follows):
        n = Counter(min(c, 5) for c in grams.values())
        levels.append(dict(zip((1, 2, 3), word_model.discounts(*[n[i] for i in (1, 2, 3, 4)]))))
    d2, d1 = levels
    total, held = Counter(), Counter()
    for (b, _), c in pairs.items():
        total[b] += c
        held[b] += d2[min(c, 3)]
    kinds, every = len(follows), sum(follows.values())
    unknown = sum(d1[min(c, 3)] for c in follows.values()) / every / (kinds + 1)

    def one(c):
        return (follows[c] - d1[min(follows[c], 3)] if follows[c] else 0) / every + unknown

    def two(b, c):
        if not total[b]:
            return one(c)
        n = pairs[b, c]
        return ((n - d2[min(n, 3)]) if n else 0) / total[b] + held[b] / total[b] * one(c)

    return lambda t: -sum(math.log(two(b, c)) for w in [words(t)] for b, c in zip(["<", *w], [*w, ">"]))


@pytest.mark.parametrize("frequent", [0, 50, word_model.MOST_FREQUENT])
def test_perplexities_are_those_of_the_definition(spark, frequent):
    """Whether n-grams are looked up by a join or in the tasks; copies, unknown words and no words among the texts."""
    trusted = TEXTS[:60]
    asked = [*TEXTS, TEXTS[0], TEXTS[0], "", None, " \n", "zzz qqq 12 12 zzz qqq", "日本語 x", "%%%"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "doc_id bigint, text string").repartition(3)
    found = word_model.perplexities(docs, docs.filter("doc_id < 60").select("text"), frequent)
    rows = {r.version: r for r in found.collect()}
    versions = {r.doc_id: r.version for r in docs.select("doc_id", F.xxhash64("text").alias("version")).collect()}
    assert len(rows) == len(set(versions.values()))
    halves = [[t for i, t in enumerate(trusted) if versions[i] & 1 != k] for k in (0, 1)]
    every, unseen = kneser_ney(trusted), [kneser_ney(h) for h in halves]
    for i, text in enumerate(asked):
        row = rows[versions[i]]
        assert row.n_words == len(words(text or ""))
        assert math.isclose(row.nll, every(text or ""), rel_tol=1e-4)
        assert math.isclose(row.unseen_nll, unseen[versions[i] & 1](text or ""), rel_tol=1e-4)


def test_pairs_hash_alike_in_tasks_and_in_spark(spark):
    _, before, word = word_model.tokens(TEXTS[:5])
    rows = spark.createDataFrame(list(zip(before.tolist(), word.tolist())), "b bigint, c bigint")
    assert [r[0] for r in rows.select(word_model._pair("b", "c")).collect()] == word_model.pair(before, word).tolist()


def test_no_trusted_text(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    assert {r.nll for r in word_model.perplexities(docs, docs.limit(0).select("text")).collect()} == {0.0}


def test_salads_of_known_symbols_are_told_by_words(spark):
    """Letters in a usual order that make no known word: the perplexity is one of words and rises."""
    rng = np.random.default_rng(3)
    clean = [" ".join(rng.choice(["river", "stone", "winter", "garden", "silver"], 40)) for _ in range(80)]
    salad = [" ".join(rng.choice(["rivter", "stoner", "wintone", "garver", "silden"], 40)) for _ in range(5)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*clean, *salad])]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(80)], "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r for r in perplexity.classify(cases.frame(spark, rows), labels).collect()}
    assert all(found[i].score > found[i].threshold and not found[i].kept for i in range(80, 85))
    p = kneser_ney(clean)
    for i, text in enumerate([*clean, *salad]):
        assert math.isclose(found[i].perplexity, math.exp(p(text) / 41), rel_tol=1e-4)


def test_slices_are_counted_and_joined_one_at_a_time_and_deleted(spark, monkeypatch):
    """Same results in several slices as in one; none holds much more than its share, and no table stays."""
    paths, sizes = [], []
    scratch, rest = word_model.scratch_dir, word_model.Weights.rest

    def noted(*args):
        paths.append(scratch(*args))
        return paths[-1]

    def counted(self, k, least):
        rows = rest(self, k, least)
        sizes.append(rows.count())
        return rows

    monkeypatch.setattr(word_model, "scratch_dir", noted)
    monkeypatch.setattr(word_model.Weights, "rest", counted)
    rows = [(i, t) for i, t in enumerate([*TEXTS, TEXTS[0], "", None])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = []
    for slice_rows in (1 << 40, 1000):
        sizes.clear()
        result = word_model.perplexities(docs, docs.filter("doc_id < 60").select("text"), 0, slice_rows)
        found.append({r.version: r for r in result.collect()})
    assert len(sizes) > 2 and max(sizes) < 1.5 * sum(sizes) / len(sizes)
    assert paths and not any(Path(p.removeprefix("file:")).exists() for p in paths)
    assert found[0].keys() == found[1].keys()
    for version, row in found[0].items():
        assert np.allclose(row, found[1][version], rtol=1e-6)
