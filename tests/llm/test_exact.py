"""Operators with a defined result against brute force: the given small tables and the hard cases."""

import hashlib

import numpy as np
import pytest

import cases
from retail_stream.llm import decontamination, host_rules, queries, simhash, warc
from retail_stream.llm.common import table

MEASURES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
HITS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.fixture(params=["given", "hard", "empty"])
def docs(request):
    return {"given": cases.documents, "hard": cases.hard_documents, "empty": list}[request.param]()


def test_host_rule_measures(spark, docs):
    found = host_rules.apply_rules(cases.frame(spark, docs, clash=True))
    assert cases.rows_of(found, *MEASURES) == cases.measures(docs)


def test_host_verdict_rejects_bad_host_only(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, "en", f"good{i % 5}", 0) for i in range(200)]
    rows += [(1000 + i, "same five words go round " * 9, "en", "bad", 0) for i in range(60)]
    rows += [(2000, good, "en", "bad", 0), (2001, good, "en", None, 0)]
    kept = {r.doc_id: r.kept for r in host_rules.apply_rules(cases.frame(spark, rows)).collect()}
    assert all(kept[i] for i in range(200)) and kept[2001]
    assert not kept[2000] and not any(kept[1000 + i] for i in range(60))


def test_decontamination(spark, docs):
    items = [r[:2] for r in cases.documents("benchmark")]
    for d in docs[:6]:
        if d[1]:
            items.append((1000 + (d[0] or 0), d[1][20:200]))
    items += [(7000, "One"), (7001, "one TWO"), (7002, ""), (7003, None), (None, "x" * 99), (7000, "One")]
    for some in (items, [i for i in items if i[1] and len(i[1]) > 100], []):
        bench = spark.createDataFrame(some, "item_id bigint, text string")
        found = decontamination.contaminated(cases.frame(spark, docs, clash=True), bench)
        assert cases.rows_of(found, *HITS) == cases.contamination(docs, some)


def test_decontamination_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    items = [r[:2] for r in cases.documents("benchmark")]
    docs = cases.documents()
    found = decontamination.contaminated(
        cases.frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert cases.rows_of(found, *HITS) == cases.contamination(docs, items)


def test_simhash(spark, docs):
    found = simhash.near_duplicates(cases.frame(spark, docs, clash=True))
    rows = sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in found.collect()), key=repr)
    assert rows == cases.simhash(docs)


def test_simhash_blocks_keep_components(spark):
    """A posting list cut into many blocks, and one far from every other."""
    rng = np.random.default_rng(1)
    values = {0x1234567890ABCDEF}
    while len(values) < 400:
        base = sorted(values)[rng.integers(len(values))]
        values.add(base ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    values |= {int(x) for x in rng.integers(0, 2**63, 50)}
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp bigint")
    found = simhash.components(simhash.links(fps, block=16))
    roots = {r.node % 2**64: r.root % 2**64 for r in found.collect()}
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(values, key=signed)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                if x != y:
                    hi, lo = (x, y) if signed(x) > signed(y) else (y, x)
                    parent[hi] = lo
    assert {v: roots.get(v, v) for v in values} == {v: root(v) for v in values}


def test_warc(spark):
    big, other = "<p>é" + "a" * 1200, "<p>" + "b" * 3000
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (2, "u", "small"), (4, "u", "small"),
            (6, "http://ü/ x\r\ny", other), (None, "n", other), (7, "e", ""), (8, "e", None),
            (9, "r", "x\r\n\r\ny" * 400), (9, "r", "x\r\n\r\ny" * 400)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    best = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if p is not None and len(b) >= 1000:
            best[b] = max(best.get(b, p), p)
    expected = []
    for p, _, h in rows:
        b = (h or "").encode()
        to = best.get(b) if len(b) >= 1000 and best.get(b) != p else None
        expected.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if to is not None else "response", to))
    found = warc.round_trip(spark, pages)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert cases.rows_of(found, *names) == sorted(expected, key=repr)
    payloads = {bytes(r.payload) for r in found.collect() if r.record_type == "response"}
    assert payloads == {(h or "").encode() for _, _, h in rows}
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_warc_reads_selected_ranges(spark, tmp_path):
    pages = table(spark, cases.SMALL, "pages")
    folder = f"file://{tmp_path}"
    index = warc.write_archives(warc.record_types(pages), folder, file_bytes=20_000)
    assert index.select("file").distinct().count() > 1
    some = index.filter("page_id % 3 = 0")
    found = {r.page_id: bytes(r.payload) for r in warc.read_archives(some, folder, gap=100, most=5000).collect()}
    expected = {r.page_id: r.html.encode() for r in pages.filter("page_id % 3 = 0").collect()}
    assert found == expected


def test_queries_return_the_contract(spark):
    columns = {
        "op1_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        "op10_simhash": ["doc_id", "fingerprint", "component_id"],
    }
    for name, expected in columns.items():
        assert queries.QUERIES[name](spark, cases.SMALL).columns == expected
