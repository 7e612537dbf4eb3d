"""Benchmark decontamination by a prefix-filtered set join, in SQL functions only.

A window is 10 consecutive words of an item (all words of a shorter one) and is taken as the set of its
positioned shingles. One scan of the documents keeps the places where any item's shingle occurs. Their
counts over all documents order the shingles by rarity; containment must be exact, so the necessary
prefix of a window is its rarest shingle alone. The prefixes are joined to the places, length and
position bounds discard starts that do not fit, and what remains is verified shingle by shingle.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_stream.llm.common import NO_ID, doc_key, stored

WINDOW = 10
SHINGLE = 3
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The items' shingles are broadcast up to this many bytes and joined by a shuffle beyond.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; an empty array for null."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(plain) == F.length(plain)
    lower = F.when(ascii_only, F.lower(plain)).otherwise(
        F.translate(plain, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lower, NOT_WORD), "")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """window (its words joined by spaces), words, item_id; one row per item and distinct window."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    n = F.size("w")
    starts = F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1)))
    return (
        rows.filter(n > 0)
        .select("item_id", "w", F.explode(starts).alias("at"))
        .select("item_id", F.slice("w", F.col("at"), F.lit(WINDOW)).alias("words"))
        .select(F.array_join("words", " ").alias("window"), "words", "item_id")
        .distinct()
    )


def window_shingles(windows: DataFrame) -> DataFrame:
    """window, n (its words), offset, shingle."""
    distinct = windows.select("window", "words").distinct()
    k = F.least(F.size("words"), F.lit(SHINGLE))
    offsets = F.sequence(F.lit(0), F.size("words") - k)
    return distinct.select("window", "words", k.alias("k"), F.explode(offsets).alias("offset")).select(
        "window", F.size("words").alias("n"), "offset", "k",
        F.array_join(F.slice("words", F.col("offset") + 1, F.col("k")), " ").alias("shingle"),
    )


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def places(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Where shingles of items occur: doc, version, n_words, pos, shingle; and for every input row one
    row more with a null shingle.

    ``version`` is a hash of the text, so that texts that share a doc_id stay apart.
    """
    tokens = (
        shingles.select("k", "shingle", F.split("shingle", " ").alias("w")).distinct()
        .withColumn("hash", reduce(
            lambda rest, k: F.when(F.col("k") == k, _hash([F.get("w", F.lit(d)) for d in range(k)])).otherwise(rest),
            range(1, SHINGLE + 1), F.lit(None).cast("bigint"),
        ))
        .groupBy("k", "hash").agg(F.collect_set("shingle").alias("shingles"))
    )
    tokens = stored(tokens, "shingles")
    size = tokens.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.array_join("shingles", " ")))).first()
    if size[0] * 64 + (size[1] or 0) <= BROADCAST_BYTES:
        tokens = F.broadcast(tokens)
    sizes = [r.k for r in shingles.select("k").distinct().orderBy("k").collect()] or [SHINGLE]
    rows = docs.select(
        doc_key().alias("doc"), F.xxhash64("text").alias("version"), words(F.col("text")).alias("w")
    )
    at = rows.select("doc", "version", "w", F.size("w").alias("n_words"), F.posexplode_outer("w").alias("pos", "word"))

    def key(k):
        parts = [F.col("word"), *[F.get("w", F.col("pos") + d) for d in range(1, k)]]
        fits = F.col("pos") + k <= F.col("n_words")
        return F.struct(
            F.lit(k).alias("k"), F.when(fits, _hash(parts)).alias("hash"),
            F.when(fits, F.concat_ws(" ", *parts)).alias("text"),
        )

    if len(sizes) == 1:
        keyed = at.select("*", key(sizes[0]).alias("key"))
    else:
        keyed = at.select("*", F.explode(F.array(*map(key, sizes))).alias("key"))
    # The document's words stay behind here: a position takes its own shingle along and no more.
    keyed = keyed.select("doc", "version", "n_words", "pos", "key.k", "key.hash", "key.text")
    first = F.coalesce(F.col("pos") == 0, F.lit(True)) & (F.col("k") == sizes[0])
    found = keyed.join(tokens, ["k", "hash"], "left").filter(F.col("shingles").isNotNull() | first)
    known = F.coalesce(F.array_contains("shingles", F.col("text")), F.lit(False))
    both = F.array(F.struct(F.lit(None).cast("string").alias("shingle"), first.alias("keep")),
                   F.struct(F.col("text").alias("shingle"), known.alias("keep")))
    return stored(
        found.select("doc", "version", "n_words", "pos", F.inline(both)).filter("keep").drop("keep"), "places"
    )


def occurrences(at: DataFrame, shingles: DataFrame) -> DataFrame:
    """doc, version, start, n, window: every occurrence of a window in a document."""
    found = at.filter("shingle is not null")
    counts = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("count"))
    # A window with a shingle that no document has cannot occur.
    ranked = shingles.join(counts, "shingle", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "offset", "shingle")).alias("rarest"),
        F.count(F.lit(1)).alias("needed"),
    ).filter("rarest.count > 0").select(
        "window", "n", "needed", F.col("rarest.offset").alias("offset"), F.col("rarest.shingle").alias("shingle")
    )
    start = F.col("pos") - F.col("offset")
    candidates = found.join(ranked, "shingle").filter(
        (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    ).select("doc", "version", start.alias("start"), "n", "needed", "window")
    expected = candidates.join(
        shingles.select("window", "offset", "shingle"), "window"
    ).withColumn("pos", F.col("start") + F.col("offset"))
    verified = expected.join(found.select("doc", "version", "pos", "shingle").distinct(), ["doc", "version", "pos", "shingle"])
    return (
        verified.groupBy("doc", "version", "start", "n", "window")
        .agg(F.count_distinct("pos").alias("got"), F.first("needed").alias("needed"))
        .filter("got = needed")
        .drop("got", "needed")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document doc_id, version (a hash of the text), n_words, n_hit (words inside an occurrence of a window), n_items and items_sha256
    (items with occurring windows, ids as sorted text), contaminated.

    One row per input row; rows with equal id and text get equal results. A null or empty text has no
    words and no hits; an item without words has no window; items without an id mark words and are not
    listed. Either table may be empty.
    """
    windows = stored(item_windows(benchmark), "windows")
    shingles = stored(window_shingles(windows), "window-shingles")
    at = places(docs, shingles)
    hits = stored(occurrences(at, shingles), "hits")
    spans = hits.groupBy("doc", "version").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spans")
    )
    total = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], s["end"]).alias("end"),
        ),
        lambda acc: acc["n"].cast("bigint"),
    )
    n_hit = spans.select("doc", "version", total.alias("n_hit"))
    items = (
        hits.select("doc", "version", "window").distinct()
        .join(windows.select("window", "item_id"), "window")
        .groupBy("doc", "version")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    every = at.filter("shingle is null").select("doc", "version", F.col("n_words").cast("bigint").alias("n_words"))
    joined = every.join(n_hit.join(items, ["doc", "version"], "left"), ["doc", "version"], "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    zero = F.lit(0).cast("bigint")
    return joined.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        "version",
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )
