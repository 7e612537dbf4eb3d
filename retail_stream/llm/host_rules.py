"""Host-level quality rules, in SQL functions only.

Each document is measured inside its own row. Rule failures are added up by host, every host's failure
rates are shrunk towards the corpus by a beta prior fitted to all hosts, and the verdicts on hosts are
joined back to the measures, which were stored and are not taken again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_stream.llm.common import WHITE, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A host goes when the shrunk rate of any rule's failures is above this.
MAX_HOST_RATE = 0.5
RULES = ("short", "repetitive", "symbols", "lines", "word_length")


def _repeat_words() -> Column:
    """Words inside a 5-word window whose sequence is found twice or more in the text.

    ``sorted`` has the hashes of the windows with their positions. Positions that have an equal
    neighbour start repeated windows, and each covers words up to the next one's start, five at most.
    Linear, however often a window repeats.
    """
    same = lambda x, other: F.coalesce(F.get("sorted", other)["h"] == x["h"], F.lit(False))
    twice = F.filter("sorted", lambda x, i: ((i > 0) & same(x, F.greatest(i - 1, F.lit(0)))) | same(x, i + 1))
    return F.aggregate(
        F.array_sort(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, s: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("n"), s.alias("last")
        ),
        lambda acc: acc["n"],
    )


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, host, and per document n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Words are runs of anything but space and \\t to \\r. A null text has no words. Windows are
    compared by 64-bit hash inside one document. Columns of ``docs`` other than doc_id, text and
    ``source`` are not looked at.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("host"),
        text.alias("text"),
        F.array_remove(F.split(text, WHITE), "").alias("words"),
    )
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    plain = F.length(F.translate("text", SYMBOLS, ""))
    n = F.size("words")
    hashes = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
            lambda i: F.xxhash64(*[F.get("words", i + d) for d in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    measured = rows.select(
        "doc_id",
        "host",
        n.cast("bigint").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda s, w: s + F.length(w)).alias("word_chars"),
        (F.length("text") - plain).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        hashes.alias("hashes"),
    )
    # Positions are needed only where a hash repeats. Columns that a lambda reads are made one step
    # before, so that they are made once per row and not once per element.
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    pairs = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = measured.withColumn("sorted", F.when(repeated, pairs))
    return marked.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(_repeat_words(), F.lit(0).cast("bigint")).alias("n_repeat_words"),
    )


def failures() -> dict[str, Column]:
    """What fails each rule; a document without words fails the first only."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "lines": 10 * F.col("n_dup_lines") > 3 * n,
        "word_length": (n > 0) & ((F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
    }


def host_verdicts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, host_kept and the shrunk rate of each rule.

    Counts come first, reduced on the map side, so one host may hold any share of the documents. The
    prior of a rule is Beta(m s, (1 - m) s): m is the corpus rate, s comes from the variance of the
    hosts' rates beyond what chance gives, by moments, between 1 and 1000; a corpus of one host, or of
    hosts that agree, gets 1000. The posterior mean is (failed + m s) / (documents + s). A null host is
    a host of its own.
    """
    fails = failures()
    counts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), *[F.sum(c.cast("bigint")).alias(f"f_{r}") for r, c in fails.items()]
    )
    moments = counts.agg(
        F.sum("docs").alias("all_docs"),
        F.count(F.lit(1)).alias("hosts"),
        *[F.sum(f"f_{r}").alias(f"s_{r}") for r in RULES],
        *[F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("docs")).alias(f"q_{r}") for r in RULES],
        F.sum(F.col("docs") * F.col("docs")).cast("double").alias("docs2"),
    )
    n, k = F.col("all_docs"), F.col("hosts")

    def prior(r):
        m = F.col(f"s_{r}") / n
        # Between-host mean square against the binomial one, with unequal host sizes.
        excess = F.col(f"q_{r}") - n * m * m - (k - 1) * m * (1 - m)
        size = n - F.col("docs2") / n
        between = F.when((k > 1) & (size > 0), excess / size)
        strength = F.when(between > 0, m * (1 - m) / between - 1).otherwise(F.lit(1000.0))
        return m, F.least(F.greatest(strength, F.lit(1.0)), F.lit(1000.0))

    priors = moments.select(*[c.alias(f"{p}_{r}") for r in RULES for p, c in zip("ms", prior(r))])
    rate = lambda r: (F.col(f"f_{r}") + F.col(f"m_{r}") * F.col(f"s_{r}")) / (F.col("docs") + F.col(f"s_{r}"))
    both = counts.join(F.broadcast(priors.withColumn("one", F.lit(1))), F.lit(1) == F.col("one"))
    rated = both.select("host", *[rate(r).alias(f"rate_{r}") for r in RULES])
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    return rated.withColumn("host_kept", worst <= max_rate)


def apply_rules(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per document its measures, ``base_failed``, the host's verdict and ``kept``. One row per input
    row, repeated and null ids included; an empty table gives none."""
    measured = stored(measures(docs), "host-measures")
    fails = failures()
    hosts = host_verdicts(measured, max_rate).withColumnRenamed("host", "of_host")
    joined = measured.join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left")
    base = fails["short"] | fails["repetitive"]
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & F.col("host_kept")).alias("kept"),
        "host", "host_kept", *[f"rate_{r}" for r in RULES],
    )
