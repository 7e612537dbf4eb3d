"""Filter audit, tries, language identification and vector codes against brute force and the hard cases."""

import hashlib
import math
import random
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import cases
from retail_stream.llm import filter_audit, language_crf, queries, text_tries, vector_codes

LABELS = "doc_id bigint, quality int, toxic int"


# --- filter audit ------------------------------------------------------------------------------


def audit(docs, labels):
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rank = lambda d: (d is None, d or 0)
    first: dict = {}
    for d, t, *_ in docs:
        first[t or ""] = min(first.get(t or "", rank(d)), rank(d))
    rows = []
    for d, t, lang, *_ in docs:
        t = t or ""
        w = cases.WORD.findall(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": first[t] < rank(d),
        }
        mine = [x for x in labels if x[0] == d and d is not None]
        rows.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = []
    for part in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == part]
        found = []
        for order in map("".join, permutations("ABCDE")):
            left = list(here)
            for s, x in enumerate(order):
                gone = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                fails = [r for r in here if r[1][x]]
                found.append([
                    part, order, s + 1, len(left), len(gone), len(fails) - len(gone),
                    sum(sum(r[1].values()) == 1 for r in fails), sum(r[2] for r in gone), sum(r[3] for r in gone),
                ])
        for f in found:
            out.append((*f, sum(g[4] for g in found if g[1][g[2] - 1] == f[1][f[2] - 1])))
    return sorted(out, key=repr)


AUDIT = (
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
)


@pytest.mark.parametrize("given", ["given", "hard"])
def test_audit(spark, given):
    docs = cases.documents() if given == "given" else cases.hard_documents()
    labels = [(d[0], i % 2, i % 3) for i, d in enumerate(docs) if i % 4] + [(None, 1, 1), (docs[0][0], None, 1)]
    found = filter_audit.audit(cases.frame(spark, docs, clash=True), spark.createDataFrame(labels, LABELS))
    assert cases.rows_of(found, *AUDIT) == audit(docs, labels)


def test_audit_without_broadcast_or_room(spark, monkeypatch):
    """Labels shuffled; tries handed on after a few bytes; many prefixes and partitions."""
    monkeypatch.setattr(filter_audit, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(text_tries, "PREFIX_BYTES", 50)
    monkeypatch.setattr(text_tries, "TASK_BYTES", 500)
    monkeypatch.setattr(
        filter_audit.text_tries, "text_groups",
        lambda rows: text_tries.merged_terminals(text_tries.local_terminals(rows, 200), 200, texts=2),
    )
    docs = [(*d[:2], "en", *d[3:]) if d[0] is not None else (10**6, *d[1:]) for d in cases.hard_documents()]
    found = filter_audit.audit(cases.frame(spark, docs), spark.createDataFrame([(0, 1, 0), (3, 0, 1)], LABELS))
    assert cases.rows_of(found, *AUDIT) == audit(docs, [(0, 1, 0), (3, 0, 1)])


def test_audit_of_empty_tables(spark):
    empty = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(cases.frame(spark, []), empty).count() == 0
    assert filter_audit.audit(cases.frame(spark, [(1, None, None, None, 0)]), empty).count() == 600


def test_audit_of_very_long_texts(spark):
    """Copies of a text of a million words, one that differs in its last letter, and a run of blanks."""
    long = " ".join(f"w{i}" for i in range(10**6))
    docs = [(1, long, "en", None, 0), (2, long, "en", None, 0), (3, long[:-1] + "x", "en", None, 0)]
    docs += [(4, " " * 10**6, "en", None, 0), (5, "", "en", None, 0)]
    found = filter_audit.audit(cases.frame(spark, docs), spark.createDataFrame([], LABELS))
    rows = {r.step: r for r in found.filter("filter_order = 'EABCD'").collect()}
    assert (rows[1].removed, rows[2].removed, rows[5].kept) == (1, 2, 2)


def test_trie_against_dict():
    rng = random.Random(3)
    trie, least = text_tries.RadixTrie(), {}
    for _ in range(4000):
        x = bytes(rng.choices(b"ab", k=rng.randint(0, 9))) + b"tail" * rng.randint(0, 12)
        n = rng.randint(0, 999)
        trie.put(x, len(x), n, {"g": (1, 1)})
        low, docs, firsts = least.get(x, (n, 0, 0))
        least[x] = (min(low, n), docs + 1, firsts + 1 if n == low else 1 if n < low else firsts)
    found = {x: (t.least, *t.groups["g"]) for x, t in trie.terminals()}
    assert found == least


def test_hot_copies_leave_a_task_once(spark):
    docs = spark.range(0, 30_000, 1, 4).select(
        F.lit("the same text").alias("text"), F.lit(0).alias("kind"), "id", F.lit("0").alias("groups_key")
    )
    rows = text_tries.local_terminals(docs)
    assert rows.count() == 4
    only = text_tries.merged_terminals(rows).collect()
    assert [(r.least, r.docs, r.firsts) for r in only] == [(0, [30_000], [1])]


# --- language identification -------------------------------------------------------------------


def marginals(scores, steps):
    """By listing every labelling of one chain."""
    from itertools import product

    length, n = scores.shape
    out, pairs, z = np.zeros((length, n)), np.zeros((n, n)), 0.0
    for path in product(range(n), repeat=length):
        p = math.exp(
            sum(scores[t, k] for t, k in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:]))
        )
        z += p
        for t, k in enumerate(path):
            out[t, k] += p
        for a, b in zip(path, path[1:]):
            pairs[a, b] += p
    return out / z, pairs / z


def test_forward_backward():
    rng = np.random.default_rng(1)
    lengths = [5, 3, 1, 4]
    scores, steps = rng.normal(size=(4, 5, 3)) * 2, rng.normal(size=(3, 3))
    mask = np.arange(5) < np.array(lengths)[:, None]
    scores[~mask] = 0
    found, pairs = language_crf.forward_backward(scores, mask, steps)
    want = [marginals(scores[c, :n], steps) for c, n in enumerate(lengths)]
    for c, n in enumerate(lengths):
        assert np.allclose(found[c, :n], want[c][0])
    assert np.allclose(pairs, sum(w[1] for w in want))


def test_gradient():
    """Of the likelihood, by differences."""
    words = np.array([["der", "die", "the"], ["of", "die", "la"]], object)
    gold = np.array([[0, 0, 1], [1, 0, 1]])
    field = language_crf.Field.start(["de", "en"], {"der": 0, "of": 1}, np.array([[1.0, -1.0], [-0.5, 0.3]]))
    flat = np.random.default_rng(2).normal(size=field.weights().size) * 0.3
    field = field.replaced(flat)

    def likelihood(f):
        total = 0.0
        for row, labels in zip(words, gold):
            known = list(row)
            s = f.emissions(known, language_crf.features(known), f.rows_of(known))
            paths = {}
            for code in range(2 ** len(row)):
                path = [code >> t & 1 for t in range(len(row))]
                paths[tuple(path)] = sum(s[t, k] for t, k in enumerate(path)) + sum(
                    f.steps[a, b] for a, b in zip(path, path[1:])
                )
            total += paths[tuple(labels)] - np.log(np.exp(list(paths.values())).sum())
        return total / words.size

    got = language_crf.gradient(field, words, gold)
    bucket = language_crf.features(["der"])[1][0]
    cut = field.hashed.size
    for at in (bucket * 2, bucket * 2 + 1, *range(cut, len(flat))):
        step = np.zeros_like(flat)
        step[at] = 1e-5
        slope = (likelihood(field.replaced(flat + step)) - likelihood(field.replaced(flat - step))) / 2e-5
        assert abs(slope - got[at]) < 1e-6


def test_features_count():
    word, bucket = language_crf.features(["a", "abc", "größe"])
    # n-grams of 2 and 3 letters, affixes of 1 to 4 letters where the word has as many
    assert np.bincount(word).tolist() == [2, 3 + 6, 7 + 8]
    again = language_crf.features(["größe"])
    assert sorted(bucket[word == 2]) == sorted(again[1])


@pytest.fixture(scope="module")
def identified(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    return docs, queries.op12_language_id(spark, path).toPandas()


def test_languages_of_held_out_texts(identified):
    docs, found = identified
    rows = found.merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(rows) == len(found) == 1000
    assert (rows.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert (held.lang == held.lang_pred).groupby(held.lang).mean().min() > 0.95
    assert rows.score.between(0, 1).all()


def test_language_of_hard_texts(spark, identified):
    docs, _ = identified
    german, spanish = (docs.filter(f"lang = '{x}' and n_chars > 2000").first().text for x in ("de", "es"))
    hard = [
        (None, german, None, None, 0), (3, None, "en", None, 0), (4, "", "en", None, 0), (5, "12 ½ #?\n", "en", None, 0),
        (6, german * 300, None, None, 0), (7, german[:1500] + spanish[:300], None, None, 0), (7, spanish, None, None, 0),
        (8, " " * 10**6, None, None, 0), (9, "x" * 10**6, None, None, 0),
    ]
    rows = cases.frame(spark, [tuple(r) for r in docs.collect()] + hard, clash=True)
    found = language_crf.identify(rows)
    known = {r[0] for r in docs.select("doc_id").collect()}
    by_score = [tuple(r) for r in found.collect() if r.doc_id is None or r.score == 0 or r.doc_id in (6, 7, 8, 9)]
    assert found.count() == len(known) + len(hard)
    assert [(r[1], r[2]) for r in by_score if r[0] is None] == [(False, "de")]
    assert sum(r[2] == "und" and r[3] == 0 for r in by_score) == 4
    assert {r[2] for r in by_score if r[0] == 7} >= {"de", "es"}


def test_nothing_to_learn_from(spark):
    docs = [(1, "some text", None, "s", 0), (2, None, None, None, 0)]
    found = language_crf.identify(cases.frame(spark, docs))
    assert sorted(map(tuple, found.select("doc_id", "lang_pred", "score").collect())) == [(1, "und", 0.0), (2, "und", 0.0)]
    assert language_crf.identify(cases.frame(spark, [])).count() == 0


def test_switched_text_is_followed(spark, identified):
    """Words of two languages in one text: the first half to one, the rest to the other."""
    docs, _ = identified
    field = language_crf.fit(docs.select("text", "lang"), 60, 2)
    german, french = (docs.filter(f"lang = '{x}' and n_chars > 2000").first().text[:600] for x in ("de", "fr"))
    words = [*language_crf.words_of(german), *language_crf.words_of(french)]
    scores = field.emissions(words, language_crf.features(words), field.rows_of(words))[None]
    path = language_crf.forward_backward(scores, np.ones((1, len(words)), bool), field.steps)[0][0].argmax(1)
    cut = len(list(language_crf.words_of(german)))
    assert (path[:cut] == field.languages.index("de")).mean() > 0.9
    assert (path[cut:] == field.languages.index("fr")).mean() > 0.9


# --- vector codes ------------------------------------------------------------------------------


def codes(rows, parts=16, entries=64, rounds=2):
    """vec_id, code, error, label_error and the codebooks' digest, without any short cut."""
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    least: dict = {}
    for i, v, _ in kept:
        k = (i is None, i or 0)
        least[k] = min(least.get(k, v), v)
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(least[k], p) for k in sorted(least)[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v, p: min((far(cut(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        new = [[list(c) for c in b] for b in books]
        for p in range(parts):
            mine: dict = {}
            for _, v, _ in kept:
                mine.setdefault(best(v, p)[1], []).append(cut(v, p))
            for e, vs in mine.items():
                new[p][e] = [sum(x) // len(vs) for x in zip(*vs)]
        books = new
    out, by_label = [], {}
    for i, v, label in kept:
        found = [best(v, p) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, c, e, by_label[x], digest) for i, c, e, x in out), key=repr)


VECTORS = "vec_id bigint, embedding array<float>, label int, code string, dist string"
CODES = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def hard_vectors(n=90):
    rng = np.random.default_rng(5)
    some = rng.normal(0, 0.05, (n, 32)).astype(np.float32).tolist()
    rows = [(int(i), v, int(i % 3) if i % 7 else None, "x", "y") for i, v in zip(rng.permutation(n) * 3 - 20, some)]
    rows += [(1000 + i, some[0], 1, "x", "y") for i in range(40)]  # one vector, many times
    rows += [rows[0], (rows[0][0], some[5], 2, "x", "y"), (None, some[7], None, "x", "y"), (None, some[8], 0, "x", "y")]
    bad = [None, [None] * 32, [float("nan")] + some[0][1:], [float("inf")] + some[0][1:], [float("-inf")] + some[0][1:]]
    rows += [(-999 - i, v, 1, "x", "y") for i, v in enumerate(bad)]
    return rows + [(5000, [1e5] * 32, 1, "x", "y"), (5001, [0.0] * 32, 1, "x", "y")]


@pytest.mark.parametrize("n", [90, 20])
def test_codes(spark, n):
    rows = hard_vectors(n)[: None if n == 90 else 30]
    found = vector_codes.digest(vector_codes.compress(spark.createDataFrame(rows, VECTORS).repartition(5)))
    assert cases.rows_of(found, *CODES) == codes([r[:3] for r in rows])


def test_codes_more_rounds_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(vector_codes, "BLOCK", 64)
    rows = hard_vectors(40)
    found = vector_codes.digest(vector_codes.compress(spark.createDataFrame(rows, VECTORS), 4, 7, 5))
    assert cases.rows_of(found, *CODES) == codes([r[:3] for r in rows], 4, 7, 5)


def test_renewed_equals_full_scan():
    """Ties included: small numbers, many equal entries."""
    rng = np.random.default_rng(9)
    for _ in range(200):
        x, old = rng.integers(-2, 3, (50, 2)), rng.integers(-2, 3, (8, 2))
        new = np.where(rng.random((8, 1)) < 0.4, rng.integers(-2, 3, (8, 2)), old)
        got = vector_codes.renewed(x, new, (new != old).any(1), *vector_codes.nearest(x, old))
        want = vector_codes.nearest(x, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_codes_of_other_lengths_and_none(spark):
    short = [(1, [0.5] * 16, 1, "", ""), (2, [0.25] * 16, 1, "", ""), (0, [0.1] * 32, 1, "", ""), (3, [], 1, "", "")]
    rows, books = vector_codes.compress(spark.createDataFrame(short, VECTORS))
    assert sorted(r.vec_id for r in rows.collect()) == [1, 2] and books.shape == (16, 2, 1)
    rows, books = vector_codes.compress(spark.createDataFrame([], VECTORS))
    assert rows.count() == 0 and books.shape == (16, 0, 1)


def test_texts_travel_in_small_batches(spark, monkeypatch):
    """Long texts of one partition come to a task a few at a time, and the session's own limit returns."""
    from retail_stream.llm import common

    rows = spark.range(0, 60, 1, 1).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"),
        F.repeat(F.col("id").cast("string"), 100_000).alias("text"),
    )
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    before, found = spark.conf.get(common.ARROW_BYTES), []

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], ["n", "bytes"])

    whole = text_tries.local_terminals

    def watched(docs, *more):
        found.extend(docs.select("text").mapInArrow(sizes, "n bigint, bytes bigint").collect())
        return whole(docs, *more)

    monkeypatch.setattr(text_tries, "local_terminals", watched)
    kept = filter_audit.audit(rows, labels).filter("filter_order = 'ABCDE' and step = 1").first()
    assert kept.kept + kept.removed == 60
    assert sum(r.n for r in found) == 60 and len(found) > 2
    assert max(r.bytes for r in found) < 2 * common.BATCH_BYTES
    assert spark.conf.get(common.ARROW_BYTES) == before
