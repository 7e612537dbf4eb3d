"""A training corpus from raw documents: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_stream.llm import decontamination, line_templates, packing, perplexity, simhash, token_counts
from retail_stream.llm.common import stored, table


# Keys of rejected documents go to the documents up to this many bytes; beyond it both are shuffled.
BROADCAST_BYTES = 32 << 20
KEY_BYTES = 16


def _small(keys: DataFrame, name: str) -> DataFrame:
    """64-bit keys, written, and marked for broadcast if their counted size is within the bound."""
    keys = stored(keys, name)
    return F.broadcast(keys) if keys.count() * KEY_BYTES <= BROADCAST_BYTES else keys


def _by_version(docs: DataFrame) -> DataFrame:
    """Documents with the hash of their text, under a name no column of theirs has."""
    return docs.withColumn("__version", F.xxhash64(F.col("text").cast("string")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the perplexity classifier keeps; null and empty texts go. The verdict belongs to (text,
    language), so repeated rows share it; an empty table stays empty."""
    rated = perplexity.classify(docs, table(spark, sf_dir, "labels"))
    gone = rated.filter(~F.col("kept")).select(F.xxhash64("version", "lang").alias("__key")).distinct()
    keyed = _by_version(docs).withColumn("__key", F.xxhash64("__version", F.col("lang").cast("string")))
    return keyed.join(_small(gone, "rejected"), "__key", "left_anti").drop("__version", "__key")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs: from the second document on where the line recurs
    as it stands. n_chars follows the text; other columns, whatever their names, stay. A null text stays."""
    found = line_templates.drop_templates(docs, line_templates.LINE_DOCS, counts=False)
    return found.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that of the smallest doc_id, ties by the hash of the text;
    of rows equal in both, one."""
    found = stored(simhash.near_duplicates(docs), "groups")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")
    stays = found.groupBy("root").agg(F.min(rank).alias("s")).select(
        F.col("s.doc_id").alias("__doc"), F.col("s.version").alias("__version")
    )
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc"))
    rows = _by_version(docs).alias("d").join(
        stays.alias("s"), (F.col("d.__version") == F.col("s.__version")) & same, "left_semi"
    )
    return rows.dropDuplicates(["doc_id", "__version"]).drop("__version")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. Null and empty texts have none and stay; repeated
    rows share their verdict; without items, or documents, nothing goes."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    gone = _small(found.filter("contaminated").select(F.col("version").alias("__version")).distinct(), "contaminated")
    return _by_version(docs).join(gone, "__version", "left_anti").drop("__version")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every remaining document goes, by its encoded tokens and one that ends it. An
    empty or null text is its end token alone; repeated rows are packed each; an empty table gives no rows."""
    return packing.best_fit(token_counts.token_lengths(docs), F.col("n_tokens") + 1)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# SQL expresses neither the language model nor best fit; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
