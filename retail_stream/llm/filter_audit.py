"""What each of several filters removes, alone and behind the others, in every order they can be applied.

A document's failures are a mask of one bit a filter. The masks of exact copies come from the tries of
``text_tries``; they are added up per part of the corpus, and every order is worked out from these sums.
"""

from __future__ import annotations

import json
import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_stream.llm import text_tries
from retail_stream.llm.common import WHITE, small_batches, stored

COPY = "E"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Labels go to the documents up to this many bytes; beyond it both are shuffled.
BROADCAST_BYTES = 32 << 20
LABEL_BYTES = 64
MARK = "\x1f"


def failures() -> dict[str, Column]:
    """What fails each filter but the one for copies, from a column ``text`` without nulls."""
    words = F.array_remove(F.split("text", WHITE), "")
    distinct = F.size(F.array_distinct(words))
    capitals = F.length("text") - F.length(F.translate("text", UPPER, ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * distinct < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length("text"),
        "D": F.rlike("text", F.lit("[#$%&*|]")),
    }


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """good and toxic per document: whether any label of its id says so."""
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("labelled")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    known = stored(known.filter("labelled is not null"), "labels")
    if known.count() * LABEL_BYTES <= BROADCAST_BYTES:
        known = F.broadcast(known)
    return docs.join(known, F.col("id") == F.col("labelled"), "left")


def mask_counts(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the filters they fail, and how many of them
    are labelled good or toxic. Bit i of the mask is the i-th filter, the highest that for copies.

    A document is a copy if a smaller doc_id of the table has the same text. Rows of one id are no copies
    of each other; a null id ranks after all others. A null text is empty.
    """
    filters = failures() if filters is None else filters
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    kind = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(filters.values())), F.lit(0))
    both = F.coalesce(F.col("good").cast("int"), F.lit(0)) + 2 * F.coalesce(F.col("toxic").cast("int"), F.lit(0))
    key = F.concat(both.cast("string"), F.lit(MARK), F.col("part"))
    rows = _labelled(slim, labels).select("text", kind.alias("kind"), "id", key.alias("groups_key"))
    copy = 1 << len(filters)
    # Of a text's documents those of the smallest id are no copies, all others are.
    entries = text_tries.text_groups(rows).select("kind", F.inline(F.arrays_zip("groups", "docs", "firsts")))
    split = entries.select(
        F.substring("groups", 1, 1).cast("int").alias("both"),
        F.expr(f"substring(groups, {len(MARK) + 2})").alias("part"),
        F.inline(F.array(
            F.struct(F.col("kind").alias("mask"), F.col("firsts").alias("n")),
            F.struct((F.col("kind") + copy).alias("mask"), (F.col("docs") - F.col("firsts")).alias("n")),
        )),
    ).filter("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("both") % 2 == 1, F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("both") >= 2, F.col("n"))), F.lit(0)).alias("toxic"),
    )


def _steps(names: str) -> list[dict[str, str | int]]:
    """Every order's steps, with the bits of the filters before and the bit of the step's own."""
    bit = {x: 1 << i for i, x in enumerate(names)}
    orders = ["".join(p) for p in permutations(names)]
    return [
        {"filter_order": o, "step": s + 1, "before": sum(bit[x] for x in o[:s]), "own": bit[o[s]]}
        for o in orders for s in range(len(o))
    ]


def interactions(counts: DataFrame, names: str) -> DataFrame:
    """Every part, order and step from the counts of masks. A part is one row until its steps are laid
    out, whatever the corpus holds."""
    fields = ("n", "good", "toxic")
    one = F.struct("mask", *fields)
    parts = counts.groupBy("part").agg(F.collect_list(one).alias("masks"))  # at most one per mask
    kind = "array<struct<filter_order:string,step:int,before:int,own:int>>"
    steps = F.from_json(F.lit(json.dumps(_steps(names))), kind)
    laid = parts.select("part", "masks", F.inline(steps))

    def total(value, when) -> Column:
        start = F.lit(0).cast("bigint")
        return F.aggregate("masks", start, lambda t, m: t + F.when(when(m["mask"]), value(m)).otherwise(F.lit(0)))

    has = lambda m, bits: m.bitwiseAND(F.col(bits)) != 0
    here = lambda m: has(m, "own") & ~has(m, "before")
    # A filter is the first of those a document fails in one of |mask| orders.
    share = lambda m: (F.lit(math.factorial(len(names))) / F.bit_count(m["mask"])).cast("bigint") * m["n"]
    return laid.select(
        "part", "filter_order", "step",
        total(lambda m: m["n"], lambda m: ~has(m, "own") & ~has(m, "before")).alias("kept"),
        total(lambda m: m["n"], here).alias("removed"),
        total(lambda m: m["n"], lambda m: has(m, "own") & has(m, "before")).alias("redundant"),
        total(lambda m: m["n"], lambda m: m == F.col("own")).alias("unique_fails"),
        total(lambda m: m["good"], here).alias("good_lost"),
        total(lambda m: m["toxic"], here).alias("toxic_lost"),
        total(share, lambda m: has(m, "own")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None) -> DataFrame:
    """Per part (language; null: empty), order of the filters and step: documents kept after the step,
    removed by it, failing its filter but removed before, failing its filter only, labelled good or toxic
    and removed by it, and the filter's removals over all orders.

    ``filters`` maps one-letter names to conditions on ``text``; the filter for copies comes after them
    under the name ``E``. Parts without a removal have zeros; an empty table gives no rows. Repeated rows
    count as often as they are there; columns other than doc_id, text and lang are not looked at.
    """
    names = "".join(failures() if filters is None else filters) + COPY
    with small_batches(docs.sparkSession):
        masks = stored(mask_counts(docs, labels, filters), "masks")
    return interactions(masks, names)
