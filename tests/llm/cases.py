"""Small documents with the hard cases, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def documents(name: str = "documents", path: str = SMALL) -> list[tuple]:
    return duckdb.sql(f"select * from '{path}/{name}.parquet' order by 1").fetchall()


def hard_documents() -> list[tuple]:
    """doc_id, text, lang, source, n_chars: copies, near copies, periodic text, blanks, nulls."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base, passage = prose(300), prose(60)
    edited = base.split()
    for at in (70, 160, 250):
        edited[at] = "changed"
    texts = [
        base, base, " ".join(edited), prose(120) + " " + passage + " " + prose(90),
        passage + "\n" + prose(80), prose(40) + "\t" + passage, "ab " * 400, "ab  ab\u000b" * 90 + prose(70),
        "x" * 500, "y" + "x" * 350, "x" * 99, "", None, " \t\n ", "one", "One two", "one two", "ONE two three",
        "É" * 200, "Ünï " * 150, prose(3000), "line a b\nline a b\nline a b\nother", "# * $ % & | < > a b c",
        base[: len(base) // 2], passage, passage.upper(), " ".join(["w"] * 120), base.replace(" ", "  "),
    ]
    rows = [(i * 3 % 89, t, "en" if i % 2 else "fr", f"h{i % 4}", 0) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, None, None, None), (None, "short null id", "en", None, 1)]
    return rows


def frame(spark, rows, clash: bool = False):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = list(rows)
    made = spark.createDataFrame(rows, schema).repartition(3)
    if not clash:
        return made
    from pyspark.sql import functions as F

    # Columns with the names operators use themselves.
    names = ("version", "words", "host", "fp", "key", "pos", "n", "minimiser", "score", "line", "shard", "code")
    return made.withColumns({c: F.lit("clash") for c in names})


def rows_of(made, *columns):
    return sorted(map(tuple, made.select(*columns).collect()), key=repr)


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def window_dedup(docs, window: int = 50):
    """doc_id, n_words, n_removed, kept_sha256."""
    first: dict = {}
    split = [(d, WORD.findall(t or "")) for d, t, *_ in docs]
    rank = lambda d: (d is None, d or 0)
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, rank(d)), rank(d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < rank(d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=repr)


def byte_dedup(docs, size: int = 100):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rank = lambda d: (d is None, d or 0)
    first: dict = {}
    # Rows of one id and different texts are ordered by a hash inside the operator; the cases have none.
    texts = [(d, (t or "").encode()) for d, t, *_ in docs]
    for d, b in texts:
        for i in range(len(b) - size + 1):
            k, at = b[i : i + size], (rank(d), i)
            first[k] = min(first.get(k, at), at)
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < (rank(d), i):
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, sha(kept)))
    return sorted(out, key=repr)


def measures(docs):
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    out = []
    for d, t, *_ in docs:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count, hit = Counter(windows), set()
        for i, x in enumerate(windows):
            if count[x] > 1:
                hit.update(range(i, i + 5))
        failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        symbols = len(re.findall(r"[#*$%&|<>]", t))
        out.append((d, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit), failed))
    return sorted(out, key=repr)


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(t):
    return BENCH_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def contamination(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = bench_words(t)
        for at in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[at : at + 10])].add(i)
    sizes = sorted({len(x) for x in windows})
    out = []
    for d, t, *_ in docs:
        w, hit, found = bench_words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return sorted(out, key=repr)


def simhash(docs, bits: int = 3):
    import xxhash

    prints = []
    for d, t, *_ in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append((d, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    values = sorted({f for _, f in prints})
    parent = {f: f for f in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    least: dict = {}
    for d, f in prints:
        if d is not None:
            least[root(f)] = min(least.get(root(f), d), d)
    return sorted(((d, f"{f:016x}", least.get(root(f))) for d, f in prints), key=repr)
