"""Message inputs, as batch or stream: ``value`` text and ``arrival_ts``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_stream.schemas import CHANGE_ENVELOPE, ROW_ENTRY, Topic, full_name

MESSAGE = "value string, arrival_ts timestamp"
# Keeps microseconds, which the default JSON timestamp format cuts.
TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_messages(
    spark: SparkSession,
    name: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Messages of one topic by its full name.

    ``kafka``: arrival is the broker's timestamp. ``json``: files under ``<path>/topic=<name>`` that
    hold one ``{"value": .., "arrival_ts": ..}`` per line, as the file sink writes them. ``text``: one
    raw message per line in ``<path>``; arrival is the file's modification time.
    """
    options = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        rows = reader.format("kafka").option("subscribe", name).options(**options).load()
        return rows.select(F.col("value").cast("string"), F.col("timestamp").alias("arrival_ts"))
    path = options.pop("path")
    if fmt == "json":
        files = reader.schema(MESSAGE).options(**TIME_OPTIONS).options(**options)
        return files.json(f"{path}/topic={name}").select("value", "arrival_ts")
    if fmt == "text":
        arrival = F.col("_metadata.file_modification_time").alias("arrival_ts")
        return reader.options(**options).text(path).select("value", arrival)
    raise ValueError(f"unknown message format: {fmt!r}")


def read_topic(
    spark: SparkSession,
    topic: Topic | str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    streaming: bool = True,
    prefix: str = "",
    most: int | None = None,
) -> DataFrame:
    """Messages of a topic of the registry. ``most`` bounds what a micro-batch takes in, so that a backlog is
    worked off in steps: messages of a Kafka topic, files of a topic of files."""
    options = dict(options or {})
    if most is not None and streaming:
        options["maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"] = str(most)
    return read_messages(spark, full_name(topic, prefix), fmt, options, streaming)


def read_raw_logs(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Raw device logs, one JSON object per line."""
    return read_messages(spark, "logs", "text", {"path": path}, streaming)


def decoded_changes(raw: DataFrame) -> DataFrame:
    """Envelopes, and of those that cannot be used the text and what is wrong. Decoded ones stay as they are: who
    needs both the good and the bad decodes before, and keeps that."""
    if "reason" in raw.columns:
        return raw
    rest = [c for c in raw.columns if c == "arrival_ts"]
    schema = T.StructType([*CHANGE_ENVELOPE.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = raw.select("value", *rest, F.inline(F.array(F.from_json("value", schema))))
    nothing = F.col("value").isNull() | (F.trim("value") == "") | F.col("_corrupt_record").isNotNull()
    reason = (
        F.when(nothing, F.lit("malformed"))
        .when(F.col("entry_type").isNull(), F.lit("missing key"))
        .when((F.col("entry_type") == ROW_ENTRY) & F.col("rows").isNull(), F.lit("no rows"))
    )
    rows = rows.withColumn("reason", reason).drop("_corrupt_record")
    return rows.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))


def parse_changes(raw: DataFrame) -> DataFrame:
    """Database changes from messages that hold one JSON envelope each; ``quarantine_changes`` has the
    others."""
    return decoded_changes(raw).filter(F.col("reason").isNull()).drop("value", "reason")


def quarantine_changes(raw: DataFrame) -> DataFrame:
    """The messages ``parse_changes`` leaves out: ``topic``, ``value``, ``reason``, maybe ``arrival_ts``."""
    rest = [c for c in raw.columns if c == "arrival_ts"]
    bad = decoded_changes(raw).filter(F.col("reason").isNotNull())
    return bad.select(F.lit("changes").alias("topic"), "value", "reason", *rest)


def read_changes(
    spark: SparkSession,
    name: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Database change envelopes from a topic or from files."""
    return parse_changes(read_messages(spark, name, fmt, options, streaming))
