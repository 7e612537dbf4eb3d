"""Interpolated modified Kneser-Ney model of word n-grams (words and pairs), whose tables stay in Spark.

Interpolated probabilities can be written as sums over the n-grams of a text: a pair that was seen adds
log p(c | b) - log gamma(b) - log p(c), a known word log p(c) - log p(unknown) and, as a context, log
gamma(b), and every prediction log p(unknown). So the different n-grams of a document are counted once, the
counts joined to the table of weights by n-gram, and summed by document. Counting and joining go slice by slice
of the n-grams' hashes.

All counts and weights are aggregations and joins sharded by n-gram or word. N-grams that are frequent in the
trusted text, at most ``MOST_FREQUENT``, go to the tasks, as a frequent key would fill one shard; so does a
filter of fixed size that tells most n-grams the table does not have. Both are bounded whatever the corpus
holds, and neither changes a result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_stream.llm.common import BATCH_BYTES, chunks, no_old_shuffles, small_batches, stored
from retail_stream.scratch import scratch_dir
from retail_stream.sinks import files

# Runs of letters, of digits, and single characters of scripts that put no spaces between words.
SINGLE = r"฀-๿぀-ヿ㐀-鿿豈-﫿"
WORD = re.compile(rf"[{SINGLE}]|[^\W\d_{SINGLE}]+|\d+")
# Stand before and after a text.
START, END = 1, 2
# Stands for the word before where an n-gram is one word.
ALONE = 0
# Frequent n-grams that are sent to the tasks, in 20 bytes each.
MOST_FREQUENT = 1 << 20
# Bits of the filter, by the first bits of an n-gram's hash.
FILTER_BITS = 26
# Words and what is known of them go to the pairs up to this many bytes; beyond it both are shuffled.
BROADCAST_BYTES = 32 << 20
WORD_BYTES = 80
# Rows of pairs, by batch, in a slice of the n-grams. One slice at a time is counted, joined and shuffled, so that
# the disk holds a part of what is shuffled; there are at most MOST_SLICES of them.
SLICE_ROWS = 2_000_000
MOST_SLICES = 12
# Words repeat within a file, so their hashes are written as places in a dictionary, which by default is given up
# when it takes 1 MB.
SMALL_FILES = {"compression": "zstd", "parquet.dictionary.page.size": str(8 << 20)}
# Models: for documents of an even hash (trained on the odd), of an odd hash, and of all trusted text.
MODELS = (0, 1, 2)
TURN = 31


def discounts(*n: int) -> list[float]:
    """D1, D2 and D3+ from how many n-grams were counted once, twice, three and four times."""
    if not all(n):
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [max(min(i - (i + 1) * y * n[i] / n[i - 1], float(i)), 0.01) for i in (1, 2, 3)]


def tokens(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every prediction of every text - its words and its end - the text's place, the hash of the word
    before and of the word itself. All numbers are one word."""
    flat: list[str] = []
    sizes = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = WORD.findall(text.lower())
        flat += found
        sizes[i] = len(found) + 1
    words = pa.array(flat, pa.string()).dictionary_encode()
    names = ["0" if w[0].isdecimal() else w for w in words.dictionary.to_pylist()]
    hashes = pd.util.hash_array(np.array(names, object), categorize=False).view(np.int64)
    ends = np.cumsum(sizes) - 1
    word, inside = np.full(sizes.sum(), END, np.int64), np.ones(sizes.sum(), bool)
    inside[ends] = False
    word[inside] = hashes[words.indices.to_numpy(zero_copy_only=False)]
    before = np.concatenate([[START], word[:-1]]).astype(np.int64)
    before[ends - sizes + 1] = START
    return np.repeat(np.arange(len(texts)), sizes), before, word


def pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a pair from those of its words, as ``_pair`` in Spark."""
    u = word.view(np.uint64)
    return before ^ ((u << np.uint64(TURN)) | (u >> np.uint64(64 - TURN))).view(np.int64)


def _pair(before: str, word: str) -> Column:
    turned = F.shiftleft(word, TURN).bitwiseOR(F.shiftrightunsigned(word, 64 - TURN))
    return F.col(before).bitwiseXOR(turned)


def pair_counts(texts: DataFrame) -> DataFrame:
    """b, c, even, odd: how often word c follows word b in texts of an even and an odd hash, a row for each batch
    of texts that has the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", BATCH_BYTES):
            odd = part.column("odd").to_numpy(zero_copy_only=False)
            doc, before, word = tokens(part.column("text").to_pylist())
            _, first, at = np.unique(pair(before, word), return_index=True, return_inverse=True)
            n = [np.bincount(at[odd[doc] == k], minlength=len(first)) for k in (0, 1)]
            columns = [before[first], word[first], *n]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in columns], ["b", "c", "even", "odd"])

    text = F.col("text").cast("string")
    rows = texts.filter(text != "").select(F.xxhash64(text).bitwiseAND(1).alias("odd"), text.alias("text"))
    return rows.mapInArrow(run, "b bigint, c bigint, even bigint, odd bigint")


def _kept(frame: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """The rows, written, and what deletes them when they have been read for the last time."""
    spark, path = frame.sparkSession, scratch_dir(frame.sparkSession, name)
    frame.write.options(**SMALL_FILES).parquet(path)
    return spark.read.schema(frame.schema).parquet(path), lambda: files.remove(spark, path)


def _in_slice(gram: Column, k: int, slices: int) -> Column:
    return F.pmod(gram, F.lit(slices)) == k


def _by_slice(counted: DataFrame, slices: int) -> tuple[DataFrame, Callable[[int], None]]:
    """The different pairs with their counts and the ``slice`` of their hash, counted slice by slice, so that only
    one is being shuffled; and what deletes a slice, or with the last one all."""
    spark, path = counted.sparkSession, scratch_dir(counted.sparkSession, "word-pairs")
    for k in range(slices):
        part = counted.filter(_in_slice(_pair("b", "c"), k, slices)).groupBy("b", "c")
        part.agg(F.sum("even").alias("even"), F.sum("odd").alias("odd")).write.options(**SMALL_FILES).parquet(f"{path}/slice={k}")
    pairs = spark.read.schema("b bigint, c bigint, even bigint, odd bigint, slice int").parquet(path)
    return pairs, lambda k: files.remove(spark, f"{path}/slice={k}" if k < slices - 1 else path)


def _off(n: Column, d: list[float]) -> Column:
    return F.when(n == 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


class Weights:
    """Every word and pair of the trusted text, in slices of their hash: ``gram``, ``n`` (how often the text has
    it) and its weight in each of the models, ``w0``, ``w1``, ``w2``. ``unknown`` is the models' log probability
    of an unknown word. A text that is null or empty is none."""

    def __init__(self, texts: DataFrame, slice_rows: int):
        counted, drop = _kept(pair_counts(texts), "pairs-by-batch")
        self.slices = min(max(-(-counted.count() // slice_rows), 1), MOST_SLICES)
        self.pairs, self._drop = _by_slice(counted, self.slices)
        drop()
        n = {0: F.col("odd"), 1: F.col("even"), 2: F.col("even") + F.col("odd")}
        seen = self.pairs.agg(*[F.count_if(n[m] == i) for m in MODELS for i in (1, 2, 3, 4)]).first()
        off = {m: _off(n[m], discounts(*seen[4 * m : 4 * m + 4])) for m in MODELS}
        contexts = self.pairs.groupBy(F.col("b").alias("word")).agg(
            *[F.sum(n[m]).alias(f"t{m}") for m in MODELS], *[F.sum(off[m]).alias(f"h{m}") for m in MODELS]
        )
        follows = self.pairs.groupBy(F.col("c").alias("word")).agg(*[F.count_if(n[m] > 0).alias(f"c{m}") for m in MODELS])
        words = contexts.join(follows, "word", "full")
        words, self._drop_words = _kept(words.select("word", *[F.coalesce(c, F.lit(0)).alias(c) for c in words.columns[1:]]), "words")
        # Continuation counts of words: counts of counts, different words, and their sum.
        sums = words.agg(
            *[x for m in MODELS for c in [F.col(f"c{m}")] for x in (*[F.count_if(c == i) for i in (1, 2, 3, 4)], F.count_if(c > 0), F.sum(c))]
        ).first()
        unknown, p = [], {}
        for m in MODELS:
            *few, kinds, total = sums[6 * m : 6 * m + 6]
            d = discounts(*few)
            held = d[0] * few[0] + d[1] * few[1] + d[2] * (kinds - few[0] - few[1])
            unknown.append(held / total / (kinds + 1) if total else 1.0)
            c = F.col(f"c{m}")
            p[m] = (c - _off(c, d)) / (total or 1) + unknown[m]
        self.unknown = [float(np.log(u)) for u in unknown]
        gamma = {m: F.when(F.col(f"t{m}") > 0, F.col(f"h{m}") / F.col(f"t{m}")).otherwise(1.0) for m in MODELS}
        sent: Callable[[DataFrame], DataFrame] = F.broadcast if words.count() * WORD_BYTES <= BROADCAST_BYTES else (lambda rows: rows)
        self._left = sent(words.select(F.col("word").alias("b"), *[F.col(f"t{m}") for m in MODELS], *[gamma[m].alias(f"g{m}") for m in MODELS]))
        self._right = sent(words.select(F.col("word").alias("c"), *[p[m].alias(f"p{m}") for m in MODELS]))
        # alpha / gamma of a pair, from its first word; with the probability of the second, its weight.
        self._ratio = {m: F.when(n[m] > 0, (n[m] - off[m]) / F.col(f"t{m}") / F.col(f"g{m}")).otherwise(0.0) for m in MODELS}
        self.words = words.select(
            F.lit(ALONE).cast("bigint").alias("b"), F.col("word").alias("c"), F.greatest("t2", "c2").alias("n"),
            *[F.log(p[m] / unknown[m] * gamma[m]).cast("float").alias(f"w{m}") for m in MODELS],
        )
        self.counts = self.words.select("b", "c", "n").unionByName(self.pairs.select("b", "c", n[2].alias("n")))

    def of(self, pairs: DataFrame) -> DataFrame:
        """b, c, n and the weights of some of the pairs."""
        ratio = [self._ratio[m].cast("float").alias(f"r{m}") for m in MODELS]
        known = pairs.join(self._left, "b").select("b", "c", (F.col("even") + F.col("odd")).alias("n"), *ratio)
        weight = [F.log(F.col(f"r{m}") / F.col(f"p{m}") + 1).cast("float").alias(f"w{m}") for m in MODELS]
        return known.join(self._right, "c").select("b", "c", "n", *weight)

    def frequent(self, least: int) -> DataFrame:
        """The weights of words and pairs counted so often."""
        often = self.pairs.filter(F.col("even") + F.col("odd") >= least)
        return self.words.filter(F.col("n") >= least).unionByName(self.of(often))

    def rest(self, k: int, least: int) -> DataFrame:
        """The weights of a slice's other words and pairs."""
        others = self.pairs.filter((F.col("slice") == k) & (F.col("even") + F.col("odd") < least))
        words = self.words.filter(_in_slice(_pair("b", "c"), k, self.slices) & (F.col("n") < least))
        return words.unionByName(self.of(others)).select(_pair("b", "c").alias("gram"), *[f"w{m}" for m in MODELS])

    def drop(self, k: int) -> None:
        """A slice's pairs have been used; with the last one the words have."""
        self._drop(k)
        if k == self.slices - 1:
            self._drop_words()


def _frequent(counts: DataFrame, most: int) -> int:
    """The smallest power of two that at most so many n-grams were counted as often as."""
    above = counts.agg(*[F.count_if(F.col("n") >= 1 << i) for i in range(62)]).first()
    return 1 << next((i for i, k in enumerate(above) if k <= most), 62)


def _filter(counts: DataFrame) -> np.ndarray:
    """A bit for each value of the first ``FILTER_BITS`` bits of the n-grams, at most 2**20 numbers."""
    place = F.shiftrightunsigned(_pair("b", "c"), 64 - FILTER_BITS)
    slots = counts.select(F.shiftright(place, 6).alias("slot"), place.alias("place"))
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = slots.groupBy("slot").agg(F.bit_or(one).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[found.column("slot").to_numpy()] = found.column("bits").to_numpy()
    return bits


def perplexities(
    docs: DataFrame, texts: DataFrame, most_frequent: int = MOST_FREQUENT, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """version (a hash of the text), n_words, nll (of all predictions, n_words + 1, by the model of all
    ``texts``) and unseen_nll (by the model of those of the other half); one row per different text."""
    with small_batches(docs.sparkSession), no_old_shuffles(docs.sparkSession):
        return _perplexities(docs, texts, most_frequent, slice_rows)


def _lookups(docs: DataFrame, weights: Weights, least: int) -> tuple[DataFrame, Callable[[], None]]:
    """A row for every n-gram of a document that is to be looked up - version, b, c, n - and one for every text,
    with copies, words and what the frequent n-grams add in each of the models; and what deletes them."""
    names = [f"w{m}" for m in MODELS]
    frequent = weights.frequent(least).select(_pair("b", "c").alias("gram"), *names).orderBy("gram").toArrow()
    grams = frequent.column("gram").to_numpy()
    values = np.stack([frequent.column(c).to_numpy() for c in names]).astype(np.float32)
    del frequent
    sent = docs.sparkSession.sparkContext.broadcast((grams, values, _filter(weights.counts.filter(F.col("n") < least))))
    del grams, values
    pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, values, bits = sent.value
        for part in chunks(batches, "text"):
            version, first, copies = np.unique(part.column("version").to_numpy(), return_index=True, return_counts=True)
            doc, before, word = tokens(part.column("text").take(pa.array(first)).to_pylist())
            size = len(version)
            n_words = np.bincount(doc, minlength=size) - 1
            # Every prediction's pair, and every word and the start as the unigram they are.
            place = np.concatenate([doc, doc, np.arange(size)])
            b = np.concatenate([before, np.full(len(word) + size, ALONE, np.int64)])
            c = np.concatenate([word, word, np.full(size, START, np.int64)])
            gram = pair(b, c)
            order = np.lexsort((gram, place))
            place, gram = place[order], gram[order]
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (place[1:] != place[:-1])
            starts = np.flatnonzero(new)
            n = np.diff(np.append(starts, len(gram)))
            place, gram = place[starts], gram[starts]
            sums = np.zeros((len(MODELS), size))
            hot = np.zeros(len(gram), bool)
            if len(grams):
                at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
                hot = grams[at] == gram
                for m in MODELS:
                    sums[m] = np.bincount(place[hot], n[hot] * values[m][at[hot]], size)
            spot = gram.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            maybe = (bits.view(np.uint64)[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1)
            asked = ~hot & (maybe == 1)
            place, n, at = place[asked], n[asked], order[starts[asked]]
            none = pa.nulls(len(at), pa.float64())
            texts_ = [pa.array(x * copies, pa.float64()) for x in (np.ones(size), n_words, *sums)]
            yield pa.record_batch(
                [
                    pa.array(np.concatenate([version[place], version]), pa.int64()),
                    *[pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(size, pa.int64())]) for x in (b[at], c[at], n * copies[place])],
                    *[pa.concat_arrays([none, x]) for x in texts_],
                ],
                ["version", "b", "c", "n", "copies", "words", *[f"s{m}" for m in MODELS]],
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(F.col("text").cast("string")).alias("version"), text.alias("text")).mapInArrow(
        run, "version bigint, b bigint, c bigint, n bigint, copies double, words double, s0 double, s1 double, s2 double"
    )
    found = _kept(rows, "lookups")
    sent.destroy()
    return found


def _perplexities(docs: DataFrame, texts: DataFrame, most_frequent: int, slice_rows: int) -> DataFrame:
    weights = Weights(texts, slice_rows)
    least = _frequent(weights.counts, most_frequent)
    lookups, drop_lookups = _lookups(docs, weights, least)
    even = F.col("version").bitwiseAND(1) == 0
    # The sums by text so far, to which every slice adds.
    sums = ["copies", "words", "every", "own"]
    added = lambda rows, name: _kept(rows.groupBy("version").agg(*[F.sum(c).alias(c) for c in sums]), name)
    own = lambda of: F.when(even, F.col(f"{of}0")).otherwise(F.col(f"{of}1"))
    so_far, drop_so_far = added(
        lookups.filter("copies is not null").select("version", "copies", "words", F.col("s2").alias("every"), own("s").alias("own")), "sums"
    )
    asked = lookups.filter("copies is null").select("version", _pair("b", "c").alias("gram"), "n")
    nothing = [F.lit(0.0).alias(c) for c in ("copies", "words")]
    for k in range(weights.slices):
        met = asked.filter(_in_slice(F.col("gram"), k, weights.slices)).join(weights.rest(k, least), "gram")
        more = met.select("version", *nothing, (F.col("n") * F.col("w2")).alias("every"), (F.col("n") * own("w")).alias("own"))
        so_far, drop, old = *added(so_far.unionByName(more), "sums"), drop_so_far
        old()
        drop_so_far = drop
        weights.drop(k)
    drop_lookups()
    n_words = F.col("words") / F.col("copies")
    nll = lambda sum_, unknown: -(F.col(sum_) / F.col("copies") + (n_words + 1) * unknown)
    unseen = F.when(even, nll("own", weights.unknown[0])).otherwise(nll("own", weights.unknown[1]))
    done = stored(
        so_far.select("version", F.round(n_words).cast("bigint").alias("n_words"), nll("every", weights.unknown[2]).alias("nll"), unseen.alias("unseen_nll")),
        "word-perplexities",
    )
    drop_so_far()
    return done
