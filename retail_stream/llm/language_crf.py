"""Languages of texts by a linear-chain conditional random field over their words.

Every word of a text gets a distribution over languages by forward-backward, from affixes, letter n-grams,
a learned lexicon and learned transitions, so a text that switches languages is followed word by word. A
text's language is the one its words belong to most.

The field is fitted on a bounded sample: of every language up to ``FIT_DOCS`` different texts, chosen by
hash among all its texts, of each up to ``FIT_BLOCKS`` blocks of words spread evenly over all of it. Folds
of the sample are trained in parallel and their weights averaged after each round. Predictions take every
word of every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_stream.llm.common import chunks, stored

UNKNOWN = "und"
HELD_OUT = 1  # remainder of crc32(doc_id) by 3
FIT_DOCS = 400
FIT_BLOCKS = 16
FIT_WORDS = 32  # of a block
FOLDS = 8
ROUNDS = 3
EPOCHS = 2
BUCKETS = 1 << 16
NGRAMS = (2, 3)
AFFIXES = (1, 2, 3, 4)
LEXICON_DOCS = 2
# Words of one chain; longer texts are several chains.
CHAIN = 128
# Words a task works on at a time.
BLOCK = 1 << 17
RATE = 0.3
BATCH = 64
SWITCH = 24  # most words between two switches of language in a training chain

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Iterator[str]:
    """Runs of letters, in lower case."""
    for m in WORD.finditer(text.lower()):
        w = m.group()
        if w.isalpha() or any(map(str.isalpha, w)):
            yield w


def features(words: Sequence[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of word index and bucket: the word's n-grams, and its affixes as families of their own."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(letters))  # letters from here to the word's end
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def bucket(values: np.ndarray, family: int) -> np.ndarray:
        h = (values + np.uint64(family)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h ^ (h >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)

    rolling = np.zeros(len(letters), np.uint64)
    for n in range(1, max(NGRAMS + AFFIXES) + 1):
        rolling = rolling[: max(0, len(letters) - n + 1)] * np.uint64(1_000_003)
        rolling = rolling + letters[n - 1 :][: len(rolling)]
        if n in NGRAMS:
            at = np.flatnonzero(left[: len(rolling)] >= n)
            found.append((word[at], bucket(rolling[at], 100 + n)))
        if n in AFFIXES:
            long = np.flatnonzero(sizes >= n)
            found.append((long, bucket(rolling[starts[long]], 200 + n)))
            found.append((long, bucket(rolling[starts[long] + sizes[long] - n], 300 + n)))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


@dataclass
class Field:
    """Weights of a field: hashed features, the lexicon's part, the prior and the transitions. The
    lexicon has for each known word the logarithm of every language's smoothed share of it."""

    languages: list[str]
    lexicon: dict[str, int]
    shares: np.ndarray
    hashed: np.ndarray
    known: np.ndarray  # per language: weight of its share, and bias of words outside the lexicon
    steps: np.ndarray

    @staticmethod
    def start(languages: list[str], lexicon: dict[str, int], shares: np.ndarray) -> Field:
        n = len(languages)
        return Field(languages, lexicon, shares, np.zeros((BUCKETS, n)), np.zeros((2, n)), np.zeros((n, n)))

    def weights(self) -> np.ndarray:
        return np.concatenate([self.hashed.ravel(), self.known.ravel(), self.steps.ravel()])

    def replaced(self, flat: np.ndarray) -> Field:
        n, cut = len(self.languages), self.hashed.size
        return Field(
            self.languages, self.lexicon, self.shares, flat[:cut].reshape(BUCKETS, n),
            flat[cut : cut + 2 * n].reshape(2, n), flat[cut + 2 * n :].reshape(n, n),
        )

    def rows_of(self, words: Sequence[str]) -> np.ndarray:
        return np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))

    def emissions(self, words: Sequence[str], pairs: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> np.ndarray:
        n = len(self.languages)
        out = np.empty((len(words), n))
        for k in range(n):
            out[:, k] = np.bincount(pairs[0], self.hashed[pairs[1], k], len(words))
        inside = rows >= 0
        out[inside] += self.shares[rows[inside]] * self.known[0]
        out[~inside] += self.known[1]
        return out


def forward_backward(
    scores: np.ndarray, mask: np.ndarray, steps: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of chains (chain, word, language), and expected transitions over all of them. ``mask``
    tells words from padding, which only comes at the end of a chain."""
    chains, length, n = scores.shape
    near = np.exp(scores - scores.max(2, keepdims=True))
    move = np.exp(steps - steps.max())
    alpha, beta = np.empty_like(near), np.ones_like(near)
    alpha[:, 0] = near[:, 0] / near[:, 0].sum(1, keepdims=True)
    for t in range(1, length):
        a = (alpha[:, t - 1] @ move) * near[:, t]
        alpha[:, t] = a / a.sum(1, keepdims=True)
    for t in range(length - 2, -1, -1):
        b = (near[:, t + 1] * beta[:, t + 1]) @ move.T
        beta[:, t] = np.where(mask[:, t + 1, None], b / b.sum(1, keepdims=True), 1.0)
    marginal = alpha * beta
    marginal /= marginal.sum(2, keepdims=True)
    if length == 1:
        return marginal, np.zeros((n, n))
    ahead = near[:, 1:] * beta[:, 1:]
    total = np.einsum("cti,ij,ctj->ct", alpha[:, :-1], move, ahead)
    weight = np.where(mask[:, 1:], 1 / total, 0.0)
    return marginal, move * np.einsum("ct,cti,ctj->ij", weight, alpha[:, :-1], ahead)


def gradient(field: Field, words: np.ndarray, gold: np.ndarray) -> np.ndarray:
    """Of the log-likelihood of chains of words (chain, word) with their languages, per word."""
    flat = words.ravel()
    at, known = pd.factorize(flat)
    pairs, rows = features(known), field.rows_of(known)
    scores = field.emissions(known, pairs, rows)[at].reshape(*words.shape, -1)
    marginal, expected = forward_backward(scores, np.ones(words.shape, bool), field.steps)
    n = len(field.languages)
    wrong = -marginal.reshape(-1, n)
    wrong[np.arange(len(flat)), gold.ravel()] += 1
    by_word = np.stack([np.bincount(at, wrong[:, k], len(known)) for k in range(n)], 1)
    hashed = np.stack([np.bincount(pairs[1], by_word[pairs[0], k], BUCKETS) for k in range(n)], 1)
    inside = rows >= 0
    share = (by_word[inside] * field.shares[rows[inside]]).sum(0)
    seen = np.bincount((gold[:, :-1] * n + gold[:, 1:]).ravel(), minlength=n * n).reshape(n, n)
    parts = (hashed.ravel(), share, by_word[~inside].sum(0), (seen - expected).ravel())
    return np.concatenate(parts) / len(flat)


def _chains(docs: list[tuple[list[str], int]], seed: int, length: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of texts of all languages, shuffled and strung together."""
    rng = np.random.default_rng(seed)
    pieces = []
    for words, label in docs:
        at = 0
        while at < len(words):
            n = int(rng.integers(1, SWITCH + 1))
            pieces.append((words[at : at + n], label))
            at += n
    order = rng.permutation(len(pieces))
    words = [w for i in order for w in pieces[i][0]]
    gold = [pieces[i][1] for i in order for _ in pieces[i][0]]
    if len(words) < length:
        length = max(1, len(words))
    n = len(words) // length * length
    return np.array(words[:n], object).reshape(-1, length), np.array(gold[:n], np.int64).reshape(-1, length)


def trained(field: Field, docs: list[tuple[list[str], int]], seed: int, epochs: int = EPOCHS) -> Field:
    """The field after some passes of AdaGrad over the chains of these texts."""
    flat, past = field.weights(), np.full(field.weights().size, 1e-8)
    for epoch in range(epochs):
        words, gold = _chains(docs, seed * 1000 + epoch)
        for a in range(0, len(words), BATCH):
            g = gradient(field.replaced(flat), words[a : a + BATCH], gold[a : a + BATCH])
            past += g * g
            flat = flat + RATE * g / np.sqrt(past)
    return field.replaced(flat)


def is_held_out(column: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 by 3; false for a null id."""
    rest = F.crc32(F.col(column).cast("string")) % 3
    return F.coalesce(rest == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, per_language: int = FIT_DOCS) -> DataFrame:
    """lang, key, words, fold: the texts a field is fitted on, from rows of text and lang.

    Texts are chosen by their hash, at a rate that gives twice the number wanted, then cut to it; copies
    of a text count once.
    """
    rows = docs.filter("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    scale = 1 << 30
    rates = [F.lit(x) for k, n in sizes.items() for x in (k, int(scale * min(1.0, 2 * per_language / n)))]
    keyed = rows.withColumn("key", F.xxhash64("text"))
    if rates:
        keyed = keyed.filter(F.pmod("key", F.lit(scale)) < F.create_map(*rates)[F.col("lang")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in chunks([batch], "text"):
                found = []
                for text in small.column("text").to_pylist():
                    words = list(words_of(text))
                    n = -(-len(words) // FIT_WORDS)
                    at = sorted({i * n // FIT_BLOCKS for i in range(FIT_BLOCKS)}) if n > FIT_BLOCKS else range(n)
                    found.append([w for b in at for w in words[b * FIT_WORDS : (b + 1) * FIT_WORDS]])
                yield pa.record_batch(
                    [small.column("lang"), small.column("key"), pa.array(found, pa.list_(pa.string()))],
                    ["lang", "key", "words"],
                )

    found = keyed.mapInArrow(cut, "lang string, key bigint, words array<string>").filter(F.size("words") > 0)
    once = found.groupBy("lang", "key").agg(F.min("words").alias("words"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    some = once.withColumn("rank", rank).filter(F.col("rank") <= per_language).drop("rank")
    return some.withColumn("fold", F.pmod("key", F.lit(FOLDS)).cast("int"))


def _trainer(field, number: dict[str, int], seed: int):
    """Trains the broadcast field on one fold."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values(["lang", "key"])
        texts = [(list(w), number[x]) for w, x in zip(ordered["words"], ordered["lang"])]
        fold = int(frame["fold"].iloc[0])
        flat = trained(field.value, texts, seed + fold).weights()
        return pd.DataFrame({"fold": [fold], "weights": [flat.astype(np.float32).tobytes()]})

    return run


def fit(docs: DataFrame, per_language: int = FIT_DOCS, rounds: int = ROUNDS) -> Field | None:
    """A field for the languages of rows of text and lang; None if there is none. What comes to the
    driver is bounded by the sample: its lexicon, and weights once per fold and round."""
    chosen = stored(sample(docs, per_language), "language-sample")
    languages = sorted(r[0] for r in chosen.select("lang").distinct().collect())
    if not languages:
        return None
    number = {x: i for i, x in enumerate(languages)}
    entries = chosen.select("lang", F.explode(F.array_distinct("words")).alias("word"))
    common = entries.groupBy("word", "lang").agg(F.count(F.lit(1)).alias("n"))
    whole = common.groupBy("word").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    )
    top = whole.filter(F.col("n") >= LEXICON_DOCS).orderBy("word").collect()
    counts = np.full((len(top), len(languages)), 0.5)
    for i, r in enumerate(top):
        for x, n in r.by.items():
            counts[i, number[x]] += n
    shares = np.log(counts / counts.sum(1, keepdims=True) * len(languages))
    field = Field.start(languages, {r.word: i for i, r in enumerate(top)}, shares)

    for step in range(rounds):
        now = docs.sparkSession.sparkContext.broadcast(field)
        run = _trainer(now, number, step * FOLDS)
        got = chosen.groupBy("fold").applyInPandas(run, "fold int, weights binary").orderBy("fold").collect()
        field = field.replaced(np.mean([np.frombuffer(r.weights, np.float32) for r in got], 0, np.float64))
        now.destroy()
    return field


def _marginals(field: Field, words: list[str], rows: np.ndarray, sums: np.ndarray) -> None:
    """Add the words' distributions to the rows they belong to. A row's words make chains of CHAIN."""
    at, known = pd.factorize(np.array(words, object))
    scores = field.emissions(known, features(known), field.rows_of(known))[at]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    size = np.diff(np.r_[first, len(rows)])
    per = -(-size // CHAIN)
    begin = np.repeat(first, per) + CHAIN * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))
    length = np.minimum(CHAIN, np.repeat(first + size, per) - begin)
    low = 0
    for high in (8, 32, CHAIN):
        some = np.flatnonzero((length > low) & (length <= high))
        low = high
        if not len(some):
            continue
        t = np.arange(length[some].max())
        mask = t < length[some, None]
        place = np.minimum(begin[some, None] + t, len(rows) - 1)
        found, _ = forward_backward(np.where(mask[:, :, None], scores[place], 0.0), mask, field.steps)
        row = rows[begin[some]]
        whole = (found * mask[:, :, None]).sum(1)
        for k in range(sums.shape[1]):
            sums[:, k] += np.bincount(row, whole[:, k], len(sums))


def shares_of(field: Field, texts: Sequence[str | None]) -> np.ndarray:
    """Per text the sum of its words' distributions; zeros for a text without a letter."""
    sums = np.zeros((len(texts), len(field.languages)))
    words: list[str] = []
    rows: list[np.ndarray] = []
    for i, text in enumerate(texts):
        source = words_of(text or "")
        while some := list(islice(source, BLOCK)):  # a multiple of CHAIN
            words += some
            rows.append(np.full(len(some), i))
            if len(words) >= BLOCK:
                _marginals(field, words, np.concatenate(rows), sums)
                words, rows = [], []
    if words:
        _marginals(field, words, np.concatenate(rows), sums)
    return sums


def predict(docs: DataFrame, field: Field | None, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` under ``row``, with lang_pred and score: the language of most of the
    words' probability, and its share of it. A null text, or one without a letter, is ``und`` with 0; ties
    go to the language that comes first."""
    if field is None:
        return docs.select(F.struct(*keep).alias("row"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    now = docs.sparkSession.sparkContext.broadcast(field)
    names = field.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sums = shares_of(now.value, batch.column("text").to_pylist())
            total, best = sums.sum(1), sums.argmax(1)
            some = total > 0
            score = np.where(some, sums[np.arange(len(sums)), best] / np.where(some, total, 1), 0.0)
            found = [names[b] if s else UNKNOWN for b, s in zip(best, some)]
            yield pa.record_batch(
                [batch.column("row"), pa.array(found, pa.string()), pa.array(np.minimum(score, 1.0))],
                ["row", "lang_pred", "score"],
            )

    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score per row of ``docs``, by a field fitted on the rows that are
    not held out and have an id and a language.

    Neither lang nor source nor doc_id take part in a prediction. Repeated rows get one row each; without
    any row to learn from every text is ``und``; an empty table gives no rows; other columns are not
    looked at.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    field = fit(docs.filter(rest != HELD_OUT).select("text", "lang"))
    slim = docs.select("doc_id", is_held_out().alias("held_out"), "text")
    texts = predict(slim, field, ["doc_id", "held_out"])
    return texts.select("row.doc_id", "row.held_out", "lang_pred", "score")
