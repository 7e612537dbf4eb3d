"""Quality classifier: an interpolated modified Kneser-Ney model of word n-grams (``word_model``), trained on
trusted text, gives every document a perplexity, held against quantiles of its language. So does, beside it,
a model of symbol n-grams: words tell text of no language, symbols tell one word repeated, or marks. A table
of words that labelled toxic documents use and trusted ones do not tells toxic documents, where one word counts.

Symbols are characters folded into 64 classes, n-grams have four of them. So a model has at most 64**4
entries whatever the corpus holds, which is the proven bound under which it is sent to the tasks. What
is gathered from the corpus - n-gram counts of all trusted text, continuation counts, context totals,
quantiles - are Spark aggregations and joins sharded by n-gram, and grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_stream.llm import word_model
from retail_stream.llm.common import chunks, no_old_shuffles, stored
from retail_stream.llm.word_model import discounts

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
# Symbol 0 stands before and after a text.
SPACE, NEWLINE, DIGIT, UPPER, LETTER, MARK, OTHER, FOREIGN = 1, 2, 3, 4, 5, 31, 55, 56
# Marks with a symbol of their own, and marks that share one.
MARKS = ".,!?:;-#*$%&|/\\<>=@^~+"
SHARED = ("()[]{}", "'\"`_")
# Share of a language's trusted documents below the threshold.
QUANTILE = 0.999
MARGIN = 0.0
# A word is held against toxic documents if so many labelled ones have it.
LEAST_TOXIC = 3
NO_LETTERS = r"[^\p{L}]+"
# A language with fewer trusted documents is held against the threshold of all of them.
LEAST_TRUSTED = 50
# Trusted ids and toxic words go to the texts up to this many bytes; beyond it texts and ids are shuffled.
BROADCAST_BYTES = 32 << 20
WORD_BYTES = 32
# Scores (deviations, log odds) are compared on this grid.
GRID = 1000


def _table() -> np.ndarray:
    table = np.full(128, OTHER, np.uint8)
    table[[9, 11, 12, 13, 32]] = SPACE
    table[10] = NEWLINE
    table[48:58] = DIGIT
    table[65:91] = UPPER
    table[97:123] = np.arange(LETTER, LETTER + 26)
    for i, marks in enumerate([*MARKS, *SHARED]):
        table[[ord(m) for m in marks]] = MARK + i
    return table


TABLE = _table()


def symbols(text: str) -> np.ndarray:
    """The symbols of a whole text with ORDER - 1 boundaries in front and one behind."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = np.zeros(len(points) + ORDER, np.int32)
    out[ORDER - 1 : -1] = np.where(
        points < 128, TABLE[np.minimum(points, 127)], FOREIGN + points % np.uint32(SYMBOLS - FOREIGN)
    )
    return out


def codes(text: str) -> np.ndarray:
    """One code per predicted symbol: it and the ORDER - 1 before it, BITS bits each."""
    s = symbols(text)
    n = len(s) - ORDER + 1
    code = s[:n].copy()
    for k in range(1, ORDER):
        code = (code << BITS) | s[k : k + n]
    return code


def gram_counts(texts: DataFrame) -> DataFrame:
    """code, c over all texts: added up in each task, then by code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, np.int32)
        for part in chunks(batches, "text", 4 << 20):
            found = [codes(x) for x in part.column("text").to_pylist() if x]
            if found:
                seen, c = np.unique(np.concatenate(found), return_counts=True)
                total[seen] += c.astype(np.int32)
        seen = np.flatnonzero(total)
        for at in range(0, len(seen), 100_000):
            some = seen[at : at + 100_000]
            yield pa.record_batch([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["code", "c"])

    rows = texts.select(F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "code bigint, c bigint").groupBy("code").agg(F.sum("c").alias("c"))


def train(texts: DataFrame) -> DataFrame:
    """k, code, alpha, gamma: for each order k its n-grams' discounted shares (alpha) and its contexts'
    weight of the order below (gamma); the other column is null.

    Order 4 has counts; lower orders have continuation counts, the number of different symbols seen in
    front. Discounts D1, D2, D3+ of an order come from its counts of counts as usual, 0.5, 1 and 1.5
    where those are too few.
    """
    # Every order is written once, and the next one below counted from it.
    grams = stored(gram_counts(texts), "grams")
    out = None
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            suffix = F.col("code").bitwiseAND(SYMBOLS**k - 1)
            grams = stored(grams.groupBy(suffix.alias("code")).agg(F.count(F.lit(1)).alias("c")), "grams")
        d = discounts(*grams.agg(*[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]).first())
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        rows = grams.select("code", F.shiftright("code", BITS).alias("context"), "c", off.alias("off"))
        context = stored(rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("off").alias("held")), "contexts")
        alpha = rows.join(context, "context").select(
            F.lit(k).alias("k"), "code", ((F.col("c") - F.col("off")) / F.col("total")).alias("alpha"),
            F.lit(None).cast("double").alias("gamma"),
        )
        gamma = context.select(
            F.lit(k).alias("k"), F.col("context").alias("code"), F.lit(None).cast("double").alias("alpha"),
            (F.col("held") / F.col("total")).alias("gamma"),
        )
        both = alpha.unionByName(gamma)
        out = both if out is None else out.unionByName(both)
    return out


def dense(k: np.ndarray, code: np.ndarray, alpha: np.ndarray, gamma: np.ndarray) -> np.ndarray:
    """The log probability of every code, from the rows of ``train``."""
    below = np.full(1, 1 / SYMBOLS, np.float32)
    for order in range(1, ORDER + 1):
        of = k == order
        p, rest = np.zeros(SYMBOLS**order, np.float32), np.ones(SYMBOLS ** (order - 1), np.float32)
        grams, contexts = of & ~np.isnan(alpha), of & ~np.isnan(gamma)
        rest[code[contexts]] = gamma[contexts]
        p[code[grams]] = alpha[grams]
        if order == 1:
            p += rest[0] * below[0]
        else:  # by first symbol, as what follows it is the code of the order below
            for row, weights in zip(p.reshape(SYMBOLS, -1), rest.reshape(SYMBOLS, -1)):
                row += weights.repeat(SYMBOLS) * below
        below = p
    return np.log(below, out=below)


def perplexities(docs: DataFrame, model: DataFrame, name: str = "perplexities") -> DataFrame:
    """doc_id, lang, version (a hash of the text), n_symbols, nll (summed negative log probability), written.
    The model leaves the driver and the tasks when that is done."""
    # At most 64**4 n-grams and their contexts, in 13 bytes each.
    kinds = {"k": "tinyint", "code": "int", "alpha": "float", "gamma": "float"}
    rows = model.select(*[F.col(c).cast(kind) for c, kind in kinds.items()]).toArrow()
    columns = [rows.column(c).to_numpy(zero_copy_only=False) for c in kinds]
    del rows
    sent = docs.sparkSession.sparkContext.broadcast(columns)
    del columns
    pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp = None
        for part in chunks(batches, "text", 4 << 20):
            if logp is None:
                logp = dense(*sent.value)
            found = [codes(x) for x in part.column("text").to_pylist()]
            nll = [-float(logp[c].sum(dtype=np.float64)) for c in found]
            yield pa.record_batch(
                [*part.columns[:-1], pa.array([len(c) for c in found], pa.int64()), pa.array(nll, pa.float64())],
                ["doc_id", "lang", "version", "n_symbols", "nll"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.xxhash64("text").alias("version"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    found = stored(rows.mapInArrow(run, "doc_id bigint, lang string, version bigint, n_symbols bigint, nll double"), name)
    sent.destroy()
    return found


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents every label of which says good and not toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return (
        labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
        .filter("good and doc_id is not null")
        .select("doc_id")
    )


def toxic_ids(labels: DataFrame) -> DataFrame:
    """Documents any label of which says toxic."""
    return labels.filter("toxic = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()


def _words(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns and one row for each different word of the row's text, in lower case."""
    words = F.array_distinct(F.split(F.lower(F.col("text").cast("string")), NO_LETTERS))
    return docs.select(*columns, F.explode(words).alias("word")).filter("word <> ''")


def _of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of stored ids; texts are shuffled only where the ids are too many to be sent to them."""
    few = 8 * ids.count() <= BROADCAST_BYTES
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def toxic_words(docs: DataFrame, trusted: DataFrame, toxic: DataFrame) -> DataFrame:
    """word, odds, own: log odds of a toxic document to have the word against a trusted one, and what
    they are for a trusted document that has it, without that document. Words of positive odds only."""
    rows = lambda ids: _words(_of_ids(docs, ids), "doc_id")
    in_toxic = rows(toxic).groupBy("word").agg(F.count(F.lit(1)).alias("t")).filter(F.col("t") >= LEAST_TOXIC)
    in_trusted = rows(trusted).groupBy("word").agg(F.count(F.lit(1)).alias("c"))
    sizes = toxic.agg(F.count(F.lit(1)).alias("n_t")).crossJoin(trusted.agg(F.count(F.lit(1)).alias("n_c")))
    odds = lambda c: F.log((F.col("t") + 0.5) / (F.col("n_t") + 1)) - F.log((c + 0.5) / (F.col("n_c") + 1))
    c = F.coalesce("c", F.lit(0))
    both = in_toxic.join(in_trusted, "word", "left").crossJoin(F.broadcast(sizes))
    return both.select("word", odds(c).alias("odds"), odds(F.greatest(c - 1, F.lit(0))).alias("own")).filter("own > 0")


def _thresholds(rated: DataFrame, quantile: float) -> DataFrame:
    """lang, threshold by histogram: the first grid value that the share of trusted rows reaches."""
    counts = rated.filter("trusted").groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"))
    every = counts.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("all"), "bin", "n")
    both = counts.withColumn("all", F.lit(False)).select("lang", "all", "bin", "n").union(every.select("lang", "all", "bin", "n"))
    of = Window.partitionBy("all", "lang")
    ranked = both.withColumns({"upto": F.sum("n").over(of.orderBy("bin")), "total": F.sum("n").over(of)})
    return (
        ranked.filter(F.col("upto") >= quantile * F.col("total"))
        .groupBy("all", "lang").agg(F.min("bin").alias("threshold"), F.first("total").alias("total"))
    )


def _scorer(good: DataFrame) -> Callable[[DataFrame, str], DataFrame]:
    """Of ``lang``, ``y`` (mean negative log probability) and ``x`` (one by the number of predictions) of
    trusted documents: what adds to other such rows, under a name, how many standard deviations ``y`` is above
    the trusted mean of the language."""
    fit = [F.count(F.lit(1)).alias("docs"), F.avg("y").alias("mean")]
    means = good.groupBy("lang").agg(*fit).filter(F.col("docs") >= LEAST_TRUSTED).select(F.col("lang").alias("of"), "mean")
    whole = good.agg(*fit).select(F.col("mean").alias("all_mean"), F.lit(1).alias("one"))
    off = (
        good.join(F.broadcast(means), F.col("lang").eqNullSafe(F.col("of")), "left")
        .withColumn("one", F.lit(1)).join(F.broadcast(whole), "one")
        .select("lang", "x", "all_mean", F.pow(F.col("y") - F.coalesce("mean", "all_mean"), 2).alias("d"))
    )
    slope = F.greatest(F.coalesce(F.covar_pop("x", "d") / F.nullif(F.var_pop("x"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    level = [F.count(F.lit(1)).alias("docs"), slope.alias("b"), F.avg("x").alias("x"), F.avg("d").alias("d")]
    # The level is no less than a tenth of the mean variance, so that no long text is held against nothing.
    fitted = lambda rows: rows.withColumn("a", F.greatest(F.col("d") - F.col("b") * F.col("x"), F.col("d") / 10, F.lit(1e-9)))
    own_fit = fitted(off.groupBy("lang").agg(*level)).filter(F.col("docs") >= LEAST_TRUSTED).select(F.col("lang").alias("of_fit"), "a", "b")
    all_fit = fitted(off.agg(*level)).select(F.col("a").alias("all_a"), F.col("b").alias("all_b"), F.lit(1).alias("one"))
    # At most a row for each language that has enough trusted documents.
    means, whole, own_fit, all_fit = (stored(f, "fit") for f in (means, whole, own_fit, all_fit))
    variance = F.coalesce("a", "all_a") + F.coalesce("b", "all_b") * F.col("x")

    def add(rows: DataFrame, name: str) -> DataFrame:
        return (
            rows.join(F.broadcast(means), F.col("lang").eqNullSafe(F.col("of")), "left")
            .join(F.broadcast(own_fit), F.col("lang").eqNullSafe(F.col("of_fit")), "left")
            .withColumn("one", F.lit(1)).join(F.broadcast(whole), "one", "left").join(F.broadcast(all_fit), "one", "left")
            .withColumn(name, (F.col("y") - F.coalesce("mean", "all_mean")) / F.sqrt(variance))
            .drop("of", "mean", "of_fit", "a", "b", "one", "all_mean", "all_a", "all_b")
        )

    return add


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """doc_id, lang, n_symbols, n_words, perplexity, score, threshold, spelling_score, spelling_threshold,
    toxicity, toxicity_threshold, version, kept; one row per input row.

    ``version`` is a hash of the text: rows of equal version and lang have equal verdicts.

    Perplexity, score and threshold are those of words, the spelling's those of symbols. A score says how many
    standard deviations the document's mean negative log probability is above its language's trusted mean. The
    deviation depends on the length: variance a + b / predictions, with a and b fitted to the language's trusted
    documents, so the threshold is one for each length and a short clean text is not taken for noise. Toxicity
    is the log odds of the document's worst word (``toxic_words``), 0 without such a word; its quantile is taken
    over trusted documents, each without its own share in the counts. Mean, deviation and quantile of the scores
    come from trusted documents too, each rated by a model of the half it is not in. A document is kept if
    toxicity and both scores are at most the quantiles of its language's trusted documents plus the margin. A
    null or empty text has no perplexity and is not kept. A language (null counts as one) with fewer than
    LEAST_TRUSTED trusted documents is held against all languages together; without any trusted document nothing
    is rejected but empty texts.
    """
    with no_old_shuffles(docs.sparkSession):
        return _classify(docs, labels, quantile, margin)


def _classify(docs: DataFrame, labels: DataFrame, quantile: float, margin: float) -> DataFrame:
    ids = stored(trusted_ids(labels), "trusted")
    numbered = docs.withColumn("doc_id", F.col("doc_id").cast("bigint")).select("doc_id", "lang", "text")
    # The words' tables take most of the disk, and read the trusted texts once: those are written after them.
    by_words = word_model.perplexities(docs, _of_ids(numbered, ids).select("text"))
    trusted = stored(_of_ids(numbered, ids), "trusted-texts")
    scored = perplexities(docs, train(trusted.select("text")))
    real = F.col("n_symbols") > 1
    # A model fits the text it was trained on better than other clean text, so trusted documents are
    # held against a model of the trusted documents with another last bit in the hash of their text.
    fold = F.xxhash64(F.col("text").cast("string")).bitwiseAND(1)
    halves = [perplexities(trusted.filter(fold == k), train(trusted.filter(fold != k).select("text")), "unseen") for k in (0, 1)]
    unseen = halves[0].unionByName(halves[1]).filter(real)
    rated_words = lambda nll: by_words.select(
        "version", "n_words", F.col(nll).alias("word_nll"),
        (F.col(nll) / (F.col("n_words") + 1)).alias("word_y"), (1 / (F.col("n_words") + 1)).alias("word_x"),
    )
    unseen = stored(unseen.join(rated_words("unseen_nll"), "version"), "unseen-rated")
    symbol, word = {"y": F.col("nll") / F.col("n_symbols"), "x": 1 / F.col("n_symbols")}, {"y": F.col("word_y"), "x": F.col("word_x")}
    scorers = {
        name: (of, _scorer(unseen.select("lang", *[c.alias(k) for k, c in of.items()])))
        for name, of in (("score", word), ("spelling_score", symbol))
    }
    words = stored(toxic_words(numbered.select("doc_id", "text"), ids, stored(toxic_ids(labels), "toxic")), "toxic-words")
    listed = F.broadcast(words) if words.count() * WORD_BYTES <= BROADCAST_BYTES else words
    worst = stored(
        _words(docs.select(F.xxhash64("text").alias("version"), "text"), "version").join(listed, "word")
        .groupBy("version").agg(F.max("odds").alias("odds"), F.max("own").alias("own")),
        "worst-words",
    )

    def rate(rows: DataFrame) -> DataFrame:
        for name, (of, add) in scorers.items():
            rows = add(rows.withColumns(of), name).drop("y", "x").withColumn(name, F.when(real, F.col(name)))
        return rows.join(worst, "version", "left").withColumns({
            "toxicity": F.greatest(F.coalesce("odds", F.lit(0.0)), F.lit(0.0)),
            "own_toxicity": F.greatest(F.coalesce("own", F.lit(0.0)), F.lit(0.0)),
        })

    columns = ["doc_id", "lang", "version", "n_symbols", "n_words", "word_nll", "score", "spelling_score", "toxicity"]
    rated = stored(rate(scored.join(rated_words("nll"), "version")).select(columns), "rated")
    bins = [F.ceil(F.col(c) * GRID).alias(c) for c in ("score", "spelling_score", "own_toxicity")]
    real_rated = stored(rate(unseen).select("lang", F.lit(True).alias("trusted"), *bins), "trusted-rated")
    held = rated.withColumn("one", F.lit(1))
    for name, bin_ in (("threshold", "score"), ("spelling_threshold", "spelling_score"), ("toxicity_threshold", "own_toxicity")):
        limits = stored(_thresholds(real_rated.select("lang", "trusted", F.col(bin_).alias("bin")), quantile), name)
        own = limits.filter(~F.col("all") & (F.col("total") >= LEAST_TRUSTED)).select(F.col("lang").alias("of"), F.col("threshold").alias("own"))
        common = limits.filter("all").agg(F.max("threshold").alias("common")).withColumn("one", F.lit(1))
        held = (
            held.join(own, F.col("lang").eqNullSafe(F.col("of")), "left").join(F.broadcast(common), "one", "left")
            .withColumn(name, F.coalesce("own", "common") / GRID + margin).drop("of", "own", "common")
        )
    fits = [
        F.coalesce(F.col(a) <= F.col(b), F.lit(True))
        for a, b in (("score", "threshold"), ("spelling_score", "spelling_threshold"), ("toxicity", "toxicity_threshold"))
    ]
    return held.select(
        "doc_id", "lang", "n_symbols", "n_words",
        F.when(real, F.exp(F.col("word_nll") / (F.col("n_words") + 1))).alias("perplexity"),
        "score", "threshold", "spelling_score", "spelling_threshold", "toxicity", "toxicity_threshold", "version",
        F.when(real, fits[0] & fits[1] & fits[2]).otherwise(F.lit(False)).alias("kept"),
    )
