"""Very long texts, large benchmarks and large archives."""

import pytest
from pyspark.sql import functions as F

import cases
from retail_stream.llm import decontamination, token_counts, warc
from retail_stream.llm.common import table


@pytest.mark.parametrize("run", [" " * 10**5, "\n" * 5000, " \t 　" * 2000, " " * 1024, " " * 1023])
@pytest.mark.parametrize("around", [("", ""), ("a", ""), ("", "b"), ("a.", "'s b"), ("1", "\x1f2")])
def test_long_white_space_is_the_piece_it_was(run, around):
    encoding = token_counts._encoding(token_counts.RANKS)
    for text in (around[0] + run + around[1], around[0] + run + "\n" + around[1] + run + "x" + run):
        assert token_counts.text_length(encoding, text) == len(encoding.encode_ordinary(text))


def test_runs_no_stack_holds(spark):
    docs = [(1, " " * 10**6, "en", "", 0), (2, "a" + "\n" * 10**7 + "b", "en", "", 0), (3, "x" * 10**6, "en", "", 0)]
    found = {r.doc_id: r.n_tokens for r in token_counts.token_lengths(cases.frame(spark, docs)).collect()}
    encoding = token_counts._encoding(token_counts.RANKS)
    piece = len(encoding._encode_single_piece("\n" * (10**7 - 1)))
    assert found[1] == 10**6 and found[2] == 1 + piece + len(encoding.encode_ordinary("\nb"))


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination_of_very_long_texts(spark, monkeypatch, broadcast):
    """A million words on either path; without a broadcast every position is shuffled."""
    if not broadcast:
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    long = " ".join(f"w{i % 5000}x{i % 7}" for i in range(10**6))
    passage = " ".join(f"item{i}" for i in range(12))
    docs = [(1, long, "en", "", 0), (2, long[:3_000_000] + " " + passage + " " + long[:3_000_000], "en", "", 0)]
    items = [(1, passage), (2, "none of this one occurs in any of the two"), (3, "item3 item4")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = {r.doc_id: r for r in decontamination.contaminated(cases.frame(spark, docs), bench).collect()}
    assert (rows[1].n_words, rows[1].n_hit) == (10**6, 0)
    assert (rows[2].n_hit, rows[2].n_items, rows[2].contaminated) == (12, 2, True)


def test_archives_are_read_by_as_many_tasks_as_they_need(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    folder = warc.scratch_dir(spark, "warc")
    index = warc.write_archives(warc.record_types(pages), folder)
    size = index.agg(F.sum("length")).first()[0]
    rows = warc.read_archives(index, folder, most=size // 40, task_bytes=size // 10)
    assert rows.rdd.getNumPartitions() >= 10 and rows.count() == pages.count()
    assert rows.groupBy(F.spark_partition_id()).count().count() >= 5
