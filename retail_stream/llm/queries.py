"""The registered queries of the operators: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_stream.llm import (
    byte_windows,
    decontamination,
    filter_audit,
    host_rules,
    language_crf,
    line_templates,
    oracle,
    packing,
    perplexity,
    simhash,
    token_counts,
    vector_codes,
    warc,
    word_windows,
)
from retail_stream.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(table(spark, sf_dir, "documents"))
    return token_counts.suffix_sums(token_counts.histogram(lengths))


def op3_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_windows.digest(word_windows.remove_repeats(table(spark, sf_dir, "documents")))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_rules(table(spark, sf_dir, "documents")).drop(
        "host", "host_kept", *[f"rate_{r}" for r in host_rules.RULES]
    )


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_templates.drop_templates(table(spark, sf_dir, "documents"), line_templates.LINE_DOCS)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perplexity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("version")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Encoded once: best_fit writes the lengths. One more token ends the document.
    lengths = token_counts.token_lengths(table(spark, sf_dir, "documents"))
    return packing.best_fit(lengths, F.col("n_tokens") + 1)


def op8_byte_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_windows.digest(byte_windows.remove_repeats(table(spark, sf_dir, "documents")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("version")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.identify(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(vector_codes.compress(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_token_counts": op2_token_counts,
    "op3_word_windows": op3_word_windows,
    "op4_host_rules": op4_host_rules,
    "op5_line_templates": op5_line_templates,
    "op6_perplexity": op6_perplexity,
    "op7_packing": op7_packing,
    "op8_byte_windows": op8_byte_windows,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
    "op11_filter_audit": op11_filter_audit,
    "op12_language_id": op12_language_id,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL: dict[str, str] = oracle.all_sql()
