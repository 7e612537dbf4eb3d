"""Line dedup by log templates: lines that recur across documents but for variable fields.

A tree of fixed depth sorts lines by their number of tokens and their leading tokens; tokens with a
digit are variable from the start. In a leaf, the tokens most of its documents share at a position form
the leaf's template, and other positions are variable fields. A line that agrees with enough of the
template belongs to it; any other line is a template of its own. Every level is a Spark aggregation over
hashes, so that a leaf or template of any size is spread; text travels only for one line of each
template in leaves that need generalising, and once more to apply the result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_stream.llm.common import WHITE, doc_key, stored

LEADING = 3
# Templates in fewer documents stay, as lines of different words may agree by chance.
MIN_DOCS = 3
# The same in the query for lines that recur as they stand.
LINE_DOCS = 2
# Shorter lines are templates as they stand.
MIN_TOKENS = 6
# Share of the tokens that have to agree with a leaf's template, leading ones included.
SIMILARITY = 0.75
FIELD = "<*>"
# White space that is more than one space between two tokens, and what makes a line not blank.
LOOSE = r"[\x09-\x0D]|\x20\x20"
TOKEN = r"[^\x20\x09-\x0D]"
# A token that has a digit; linear, as a token is looked at once.
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def masked(line: Column) -> Column:
    """The line's tokens with one space between them, variable ones as a field; empty for a blank line."""
    squeezed = F.trim(F.when(F.rlike(line, F.lit(LOOSE)), F.regexp_replace(line, WHITE, " ")).otherwise(line))
    return F.when(F.rlike(line, F.lit("[0-9]")), F.regexp_replace(squeezed, VARIABLE, FIELD)).otherwise(squeezed)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_key().alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))


def _lines(docs: DataFrame) -> DataFrame:
    """doc, version, at, leaf, template, n for every line that is not blank."""
    lines = _keyed(docs).select("doc", "version", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    # A filter on the masked line would have every line masked twice, for the filter and for the rows.
    some = lines.filter(F.rlike("line", F.lit(TOKEN)))
    tokens = some.select("doc", "version", "at", masked(F.col("line")).alias("masked"))
    n = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    return tokens.select(
        "doc", "version", "at", n.alias("n"), F.xxhash64("masked").alias("template"),
        F.xxhash64(n, F.substring_index("masked", " ", LEADING)).alias("leaf"),
    )


def _generalised(docs: DataFrame, seen: DataFrame, similarity: float, min_docs: int) -> DataFrame:
    """template, leaf of the templates that belong to their leaf's own template."""
    leaves = (
        seen.filter(F.col("n") >= MIN_TOKENS).groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("templates"), F.sum("docs").alias("leaf_docs"))
        .filter((F.col("templates") > 1) & (F.col("leaf_docs") >= min_docs))
    )
    wanted = seen.filter(F.col("n") >= MIN_TOKENS).join(leaves, "leaf").select(
        "leaf", "leaf_docs", "template", "docs", "n", F.col("first.doc").alias("doc"),
        F.col("first.version").alias("version"), F.col("first.at").alias("at"),
    )
    lists = wanted.groupBy("doc", "version").agg(
        F.collect_list(F.struct("leaf", "leaf_docs", "template", "docs", "n", "at")).alias("items")
    )
    cut = _keyed(docs).join(lists, ["doc", "version"]).withColumn("lines", F.split("text", "\n", -1)).select(
        "lines", F.inline("items")
    )
    tokens = stored(
        cut.select("leaf", "leaf_docs", "template", "docs", "n", F.get("lines", F.col("at")).alias("line"))
        .select("leaf", "leaf_docs", "template", "docs", "n", F.split(masked(F.col("line")), " ").alias("tokens"))
        .select("leaf", "leaf_docs", "template", "docs", "n", F.posexplode("tokens").alias("j", "token"))
        .filter(F.col("j") >= LEADING)
        .distinct(),
        "template-tokens",
    )
    common = (
        tokens.groupBy("leaf", "leaf_docs", "j", "token").agg(F.sum("docs").alias("w"))
        .filter(2 * F.col("w") > F.col("leaf_docs")).select("leaf", "j", "token")
    )
    agree = tokens.join(common, ["leaf", "j", "token"]).groupBy("leaf", "template", "n").agg(
        F.count(F.lit(1)).alias("equal")
    )
    return agree.filter(F.col("equal") + LEADING >= similarity * F.col("n")).select("template", "leaf")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY, general_docs: int = MIN_DOCS) -> DataFrame:
    """doc, version, dropped: numbers of the lines whose template occurs in at least ``min_docs``
    documents (``general_docs`` where it stands for lines of different words), of which this one is not the first. Rows that share an id count as one document."""
    lines = stored(_lines(docs), "lines")
    pairs = lines.groupBy("leaf", "template", "n", "doc").agg(F.min(F.struct("version", "at")).alias("v"))
    seen = stored(
        pairs.groupBy("leaf", "template", "n").agg(
            F.count(F.lit(1)).alias("docs"),
            F.min(F.struct("doc", F.col("v.version").alias("version"), F.col("v.at").alias("at"))).alias("first"),
        ),
        "templates",
    )
    members = stored(_generalised(docs, seen, similarity, general_docs), "members")
    named = seen.join(members.withColumn("general", F.lit(True)), ["leaf", "template"], "left")
    # Templates of one leaf that were generalised are counted together, document by document.
    # A line that recurs as it stands counts by itself too, if its leaf is in too few documents.
    own = named.filter(F.col("docs") >= min_docs).select(
        "leaf", "template", "n", F.col("first.doc").alias("first_doc")
    )
    general = named.filter("general").select("leaf", "template", "n")
    leaf_docs = (
        pairs.join(general, ["leaf", "template", "n"]).select("leaf", "n", "doc").distinct()
        .groupBy("leaf", "n").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first_doc"))
        .filter(F.col("docs") >= general_docs)
    )
    recurring = own.unionByName(
        general.join(leaf_docs, ["leaf", "n"]).select("leaf", "template", "n", "first_doc")
    ).groupBy("leaf", "template", "n").agg(F.min("first_doc").alias("first_doc"))
    return (
        lines.join(recurring, ["leaf", "template", "n"]).filter(F.col("doc") > F.col("first_doc"))
        .groupBy("doc", "version").agg(F.collect_set("at").alias("dropped"))
    )


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, dropped: pd.Series) -> pd.Series:
    def keep(t, gone):
        if gone is None or t is None:
            return t
        gone = set(gone.tolist())
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)

    return pd.Series([keep(t, g) for t, g in zip(text, dropped)], dtype=object)


def drop_templates(
    docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY, general_docs: int = MIN_DOCS,
    counts: bool = True,
) -> DataFrame:
    """The input rows with text without recurring lines, and with ``counts`` n_lines and n_dropped, which take
    the place of columns of these names.

    A template in ``min_docs`` (generalised: ``general_docs``) or more documents stays in the first of them, by smallest doc_id, and is
    dropped from the others; so copies lose their lines, and no line is lost altogether. Ids that are
    null rank after all others and are one document. Blank lines stay. A null text stays null and has no
    lines; a document may end up empty and stays a row. Other columns pass unchanged.
    """
    found = recurring_lines(docs, min_docs, similarity, general_docs).select(
        F.col("doc").alias("__doc"), F.col("version").alias("__version"), "dropped"
    ).withColumnRenamed("dropped", "__dropped")
    text = F.col("text").cast("string")
    keyed = docs.withColumns({"__doc": doc_key(), "__version": F.xxhash64(F.coalesce(text, F.lit("")))})
    joined = keyed.join(found, ["__doc", "__version"], "left")
    # Only texts that lose a line travel to Python.
    gone = F.col("__dropped")
    made = {"text": F.when(gone.isNull(), text).otherwise(_without(F.when(gone.isNotNull(), text), gone))}
    if counts:
        breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
        made["n_lines"] = F.when(text.isNull(), 0).otherwise(breaks + 1).cast("bigint")
        made["n_dropped"] = F.coalesce(F.size(gone), F.lit(0)).cast("bigint")
    return joined.withColumns(made).drop("__doc", "__version", "__dropped")
