"""Annotations of the built-in rules: from whole batches as column by column, and what moves with a large gazetteer."""

from pyspark.sql import functions as F

from jobsift import limits
from jobsift.operators import annotate

TEXTS = [
    "The Quick Brown fox (12) is running quickly! And Anna Berg-Olsen paid $5.  ... ok? Yes",
    "New York City. York New York  !  . Anna's café naïvely 中文 İstanbul x_y 3rd \U0001d400b́ ٣ Ⅰ",
    "a", ".", "", "   ", None, "Dogs.  Dogs dogs.\nUnder the Dogs",
]


def corpus(spark):
    rows = [(i % 3 or None, t) for i, t in enumerate(TEXTS * 4)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_rules_in_batches_equal_the_rules_by_column(spark, monkeypatch):
    monkeypatch.setattr(annotate, "SLICE_WORDS", 12)
    text = annotate.text_of("text")
    by_column = corpus(spark).withColumn("tokens", annotate.rule_tokens(text))
    by_column = by_column.withColumn("spans", annotate.noun_chunks(F.col("tokens")))
    in_batches = annotate.annotate(corpus(spark), "text")
    assert in_batches.columns == by_column.columns
    assert sorted(map(repr, in_batches.collect())) == sorted(map(repr, by_column.collect()))
    plan = in_batches.select("spans")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # tokens that nobody reads are not made


def test_annotations_do_not_move_with_a_large_gazetteer(spark, monkeypatch):
    names = [("New York", "GPE"), ("York", "LOC"), ("Dogs", "ORG"), ("New York City", "GPE"), ("Absent", "ORG")]
    entries = spark.createDataFrame(names, "surface string, label string")
    shipped = annotate.annotate(corpus(spark), "text", gazetteer=entries)
    expected = sorted(map(repr, shipped.collect()))
    monkeypatch.setattr(annotate, "GROUP_WORDS", 20)
    monkeypatch.setattr(annotate, "SLICE_WORDS", 12)
    monkeypatch.setattr(limits.small_rows, "__defaults__", (2,))
    written = []
    keep = annotate.stored
    monkeypatch.setattr(annotate, "stored", lambda df, name: written.append(df.columns) or keep(df, name))
    pieced = annotate.annotate(corpus(spark), "text", gazetteer=entries)
    assert pieced.columns == shipped.columns
    assert sorted(map(repr, pieced.collect())) == expected
    assert not any("tokens" in columns for columns in written)
