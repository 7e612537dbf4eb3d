"""The stages of the pipeline, each on what the one before kept, against brute force."""

import pytest
from pyspark.sql import functions as F

import cases
import corpus_pipeline
from retail_stream.llm import line_templates, token_counts
from retail_stream.llm.common import stored
from test_models import templates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(frame):
    return sorted(map(tuple, frame.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("which", ["given", "hard", "empty"])
def test_stages(spark, which):
    before = {"given": cases.documents, "hard": cases.hard_documents, "empty": list}[which]()
    docs = cases.frame(spark, before)
    items = [r[:2] for r in cases.documents("benchmark")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, cases.SMALL), name)
        assert docs.columns == COLUMNS
        after = rows_of(docs)
        if name == "quality":
            assert set(after) <= set(before) and all(t for _, t, *_ in after)
            clean = {d for d, q, t in cases.documents("labels") if q == 1 and t == 0}
            kept = {d for d, *_ in after}
            if which == "given":
                assert len(clean & kept) >= 0.99 * len(clean & {d for d, *_ in before})
                assert len(after) < len(before)
        elif name == "lines":
            expected = [(d, t) for d, t, _ in templates(before, line_templates.LINE_DOCS)]
            assert sorted(((d, t) for d, t, *_ in after), key=repr) == expected
            assert all(n == len(t) for _, t, _, _, n in after)
        elif name == "near_duplicates":
            groups = cases.simhash(before)
            assert set(after) <= set(before)
            assert {d for d, *_ in after} == {c for _, _, c in groups}
            assert len(after) == len({c for _, _, c in groups})
        else:
            dirty = {r[0] for r in cases.contamination(before, items) if r[-1]}
            assert after == sorted((r for r in before if r[0] not in dirty), key=repr)
        before = after
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, cases.SMALL).collect()
    encoding = token_counts._encoding(token_counts.RANKS)
    tokens = sum(len(encoding.encode_ordinary(t or "")) + 1 for _, t, *_ in before)
    assert sum(r.n_tokens for r in placed) == tokens
    assert {r.doc_id for r in placed} == {d for d, *_ in before}


def test_near_duplicates_keep_one_of_equal_rows(spark):
    rows = [(1, "a b c d", "en", "s", 7)] * 3 + [(None, "x y z", None, None, None)] * 2
    kept = corpus_pipeline.near_duplicates(spark, cases.frame(spark, rows), cases.SMALL)
    assert rows_of(kept) == sorted({rows[0], rows[-1]}, key=repr)


def test_run_writes_every_stage(spark):
    placed = corpus_pipeline.run(spark, cases.SMALL)
    assert placed.count() > 0 and corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontaminate", "pack"]


def test_stages_keep_columns_of_any_name(spark):
    """Names the operators use themselves, filled by the caller."""
    names = ["n_lines", "n_dropped", "version", "score", "kept", "key", "root", "n_tokens", "line", "window"]
    rows = cases.documents()[:60]
    docs = cases.frame(spark, rows).withColumns({n: F.lit(777) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, cases.SMALL), name)
        assert docs.columns == [*COLUMNS, *names]
        assert docs.filter(" or ".join(f"{n} <> 777 or {n} is null" for n in names)).count() == 0
    assert corpus_pipeline.pack(spark, docs, cases.SMALL).count() >= docs.count() > 0
