"""Token counts of whole texts and an exact length histogram that answers every context limit.

Texts are encoded inside tasks; documents are then aggregated by encoded length. Suffix sums over the
histogram give, for a context limit L, the documents and tokens of at least L tokens, and with them
totals, quantiles and truncated totals, without looking at a document again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that belongs to the ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The characters the pattern calls white space.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Runs of white space from this length on are cut out of a text before it is split by the pattern.
LONG_RUN = re.compile(f"[{SPACES}]{{1024,}}")
# Lengths of one block are summed in one task: at most so many rows.
BLOCK = 4096

_ENCODINGS: dict = {}


def _encoding(ranks_path: str):
    if ranks_path not in _ENCODINGS:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[ranks_path] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODINGS[ranks_path]


def text_length(encoding, text: str) -> int:
    """Tokens of a text. The pattern makes one piece of a run of white space but its last character, which
    belongs to what follows, and of a run at the end as a whole. Matching that takes stack for every
    character, so long runs are encoded as the piece they are."""
    tokens, at = 0, 0
    for run in LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        tokens += len(encoding.encode_ordinary(text[at : run.start()]))
        tokens += len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return tokens + len(encoding.encode_ordinary(text[at:] if at else text))


def token_lengths(docs: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """doc_id and n_tokens per document; a null or empty text has none, a text of any length is encoded
    whole, repeated rows get one row each. The vocabulary file is read by every worker, so its path must
    exist on all machines."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(ranks_path)
        for frame in frames:
            counts = [0 if x is None else text_length(encoding, x) for x in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_tokens": counts})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id bigint, n_tokens bigint")


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, n_docs: exact, reduced on the map side whatever length most documents have."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per length that occurs, taken as a context limit L = n_tokens:

    docs_from, tokens_from: documents of at least L tokens and their tokens;
    truncated_tokens: tokens left when every document is cut to L;
    quantile: share of documents of at most L tokens.

    Sums run in two levels, inside blocks of BLOCK lengths and over the blocks, so that no task orders
    all lengths of a corpus with very long documents; the blocks, at most the longest document's tokens /
    BLOCK, are ordered in one task. An empty corpus gives no row.
    """
    rows = hist.select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / BLOCK).alias("block"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = (
        rows.groupBy("block")
        .agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
            F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
            F.sum("d").over(every).alias("docs"),
            F.sum("t").over(every).alias("all_tokens"),
        )
    )
    summed = rows.withColumns(
        {"d": F.sum("n_docs").over(inside), "t": F.sum("tokens").over(inside)}
    ).join(blocks, "block")
    docs_from, tokens_from = F.col("d") + F.col("docs_above"), F.col("t") + F.col("tokens_above")
    return summed.select(
        "n_tokens",
        "n_docs",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        (F.col("all_tokens") - tokens_from + F.col("n_tokens") * docs_from).alias("truncated_tokens"),
        ((F.col("docs") - docs_from + F.col("n_docs")) / F.col("docs")).alias("quantile"),
    )


def answers(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """limit, docs_from, tokens_from, truncated_tokens for any limits, from the suffix sums alone.

    A limit is answered by the smallest length that occurs and is not below it; above the longest
    document no document is left and nothing is cut. Without documents all are 0.
    """
    at = {n: F.min(F.when(F.col("n_tokens") >= n, F.struct("n_tokens", "docs_from", "tokens_from"))) for n in limits}
    total = F.coalesce(F.max("tokens_from"), F.lit(0))
    rows = [
        F.struct(
            F.lit(n).cast("bigint").alias("limit"),
            F.coalesce(r["docs_from"], F.lit(0)).alias("docs_from"),
            F.coalesce(r["tokens_from"], F.lit(0)).alias("tokens_from"),
            (total - F.coalesce(r["tokens_from"], F.lit(0)) + n * F.coalesce(r["docs_from"], F.lit(0))).alias("truncated_tokens"),
        )
        for n, r in at.items()
    ]
    return sums.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share, n_tokens: the smallest length that at least this share of the documents does not exceed;
    null without documents."""
    rows = [
        F.struct(
            F.lit(float(q)).alias("share"), F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias("n_tokens")
        )
        for q in shares
    ]
    return sums.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
