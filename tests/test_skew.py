"""One key holding a third of all rows must not change a result."""

import pytest
from pyspark.sql import functions as F

from jobsift import limits
from jobsift.operators import clean, model, tfidf, web


@pytest.fixture
def hot_docs(spark):
    """Every third document is the same text."""
    return spark.range(1500).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot words here")
        .otherwise(F.concat(F.lit("cold"), (F.col("id") % 50).cast("string"), F.lit(" words")))
        .alias("t"),
    )


@pytest.mark.parametrize("limit", [200_000, 10])
def test_hot_terms(hot_docs, monkeypatch, limit):
    monkeypatch.setattr(limits, "MAX_BROADCAST_ROWS", limit)
    matrix, vocab = tfidf.build_tfidf(hot_docs, "t", 200)
    counts = {r.term: (r.cf, r.df) for r in vocab.collect()}
    assert counts["words"] == (1500, 1500)
    assert counts["hot words"] == (500, 500) and counts["cold7 words"] == (20, 20)
    assert matrix.filter("term = 'words'").count() == 1500


def test_hot_form_in_a_large_dictionary(spark, hot_docs):
    tokens = hot_docs.withColumn("tokens", F.split("t", " "))
    dictionary = spark.createDataFrame([("words", "word")], "form string, lemma string")
    got = clean.lemmatize_by_join(tokens, "tokens", "lemmas", dictionary)
    assert got.filter(F.array_contains("lemmas", "word")).count() == 1500
    assert got.filter(F.col("lemmas") == F.array(F.lit("hot"), F.lit("word"), F.lit("here"))).count() == 500


def test_hot_label(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 100)).alias("label_area"),
    )
    split = model.stratified_split(df)
    assert split.count() == 3000 and split.filter("is_test").count() == 600
    assert split.filter("is_test and label_area = 'hot'").count() == 200


def test_any_number_of_labels_is_split(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 1000).cast("string").alias("y"))
    split = model.stratified_split(df, "y", test_size=0.5)
    per_label = split.groupBy("y").agg(F.sum(F.col("is_test").cast("int")).alias("n")).collect()
    assert len(per_label) == 1000 and {r.n for r in per_label} == {1}


def test_hot_url(spark):
    links = spark.range(3000).select(
        (F.col("id") % 7).cast("int").alias("cat_order"),
        F.col("id").cast("int").alias("page"),
        F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"),
    )
    got = web.first_seen_urls(links, 5000).collect()
    assert len(got) == 2001 and got[0].url == "hot"
