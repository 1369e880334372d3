"""A gazetteer too large for the tasks: what moves, and equal results."""

from pyspark.sql import functions as F

from jobsift import limits
from jobsift.operators import annotate


def corpus(spark):
    rows = [(i % 7 or None, f"We met Anna Berg{i % 5} in New York. Anna ran. York New City {i}!") for i in range(60)]
    docs = spark.createDataFrame([*rows, (1, ""), (2, None)], "doc_id long, descricao_texto string").repartition(3)
    names = [("New York", "GPE"), ("York", "LOC"), ("Anna", "PERSON"), ("New York City", "GPE"), ("Anna  ran", "ORG"), ("Absent", "ORG")]
    return docs, spark.createDataFrame(names, "surface string, label string")


def test_group_meets_each_entry_once(spark, monkeypatch):
    docs, entries = corpus(spark)
    grouped = docs.withColumn("_group", F.lit(4).cast("long")).coalesce(1)
    words = grouped.select("_group", annotate.sentence_words(F.coalesce("descricao_texto", F.lit(""))).alias("s"))
    found = annotate._pieces(words, entries, annotate._listed_sentences).collect()
    assert sorted(tuple(r) for r in found) == [(4, "Anna", "PERSON"), (4, "New York", "GPE"), (4, "York", "LOC")]


def test_summaries_of_text_with_pieces(spark, monkeypatch):
    docs, entries = corpus(spark)
    monkeypatch.setattr(annotate, "GROUP_WORDS", 50)
    monkeypatch.setattr(annotate, "SLICE_WORDS", 20)
    monkeypatch.setattr(limits.small_rows, "__defaults__", (2,))
    whole = annotate.annotate
    monkeypatch.setattr(annotate, "annotate", lambda *a, **k: 1 / 0)  # the way over annotations kept them all
    joined = sorted(map(repr, annotate.summarize_text(docs, gazetteer=entries).collect()))
    spans = sorted(map(repr, annotate.add_gazetteer_spans(whole(docs), entries).drop("tokens").collect()))
    monkeypatch.setattr(limits.small_rows, "__defaults__", (200_000,))
    assert joined == sorted(map(repr, annotate.summarize_text(docs, gazetteer=entries).collect()))
    assert spans == sorted(map(repr, annotate.add_gazetteer_spans(whole(docs), entries).drop("tokens").collect()))
