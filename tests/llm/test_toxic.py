"""What the quality classifier keeps of documents whose labels it did not see."""

from pyspark.sql import functions as F

from retail_stream.llm import perplexity
from retail_stream.llm.common import table

INSULTS = "trash|pathetic|idiot|disgusting|worthless|clown|loser|scum|stupid|moron"


def test_toxic_and_short_junk_recall(spark):
    """An insult counts however long the document is; clean documents, short ones too, stay."""
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rated = perplexity.classify(docs, labels.filter("doc_id % 2 = 0"))
    texts = docs.select("doc_id", F.lower("text").rlike(INSULTS).alias("insult"))
    held = rated.join(labels.filter("doc_id % 2 = 1"), "doc_id").join(texts, "doc_id").cache()
    share = lambda rows: rows.agg(F.avg(F.col("kept").cast("int"))).first()[0]
    clean, short = held.filter("quality = 1 and toxic = 0"), F.col("n_symbols") < 300
    assert share(held.filter("toxic = 1 and insult")) < 0.02
    assert share(held.filter("quality = 1 and toxic = 1")) < 0.4
    assert share(held.filter("quality = 0")) < 0.06
    assert share(held.filter("quality = 0").filter(short)) <= 0.4
    assert share(clean) > 0.995 and share(clean.filter(short)) > 0.95


def test_thresholds_per_language_and_length(spark):
    """The same score is the same number of deviations: a short clean text deviates more in the mean."""
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    found = perplexity.classify(docs, labels).filter("n_symbols > 1").cache()
    assert found.filter("kept and (score > threshold or toxicity > toxicity_threshold)").count() == 0
    limits = found.groupBy("lang").agg(F.countDistinct("threshold").alias("n"))
    assert [r.n for r in limits.collect()] == [1] * limits.count()
