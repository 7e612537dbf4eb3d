"""Lines that only two documents share."""

import cases
from retail_stream.llm import line_templates
from retail_stream.llm.common import table
from retail_stream.llm.queries import op5_line_templates


def test_the_query_drops_pairs(spark):
    """More lines go than with one count of three for lines and templates."""
    dropped = {r.doc_id: r.n_dropped for r in op5_line_templates(spark, cases.SMALL).select("doc_id", "n_dropped").collect()}
    before = {r.doc_id: r.n_dropped for r in line_templates.drop_templates(table(spark, cases.SMALL, "documents")).collect()}
    assert all(dropped[d] >= before[d] for d in before) and sum(dropped.values()) > sum(before.values())


def test_a_line_in_two_documents_stays_in_the_first(spark):
    passage = "one whole passage of plain words that two documents share"
    varied = "alpha beta gamma delta epsilon zeta eta theta {} kappa"
    texts = [f"{passage}\nfirst", f"second\n{passage}", varied.format("iota"), varied.format("mu"), "third"]
    docs = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    found = {r.doc_id: r.text for r in line_templates.drop_templates(cases.frame(spark, docs), line_templates.LINE_DOCS).collect()}
    # Two lines of different words may agree by chance: their template needs a third document.
    assert found == dict(enumerate(texts)) | {1: "second"}
    docs.append((9, varied.format("nu"), None, None, 0))
    found = {r.doc_id: r.text for r in line_templates.drop_templates(cases.frame(spark, docs), line_templates.LINE_DOCS).collect()}
    assert (found[2], found[3], found[9]) == (texts[2], "", "")
