"""Dictionary forms by the join: words move once per group of rows, and rows are kept as they are."""

from pyspark.sql import functions as F

from jobsift.operators import clean
from jobsift.session import ship_package


def test_words_move_once_per_group(spark, monkeypatch):
    ship_package(spark)
    rows = [(1, ["cats", None, "dogs", "cats"]), (1, ["cats", None, "dogs", "cats"]), (None, []), (2, None), (3, ["x"])]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    many = docs.unionByName(spark.range(400).select(F.col("id").alias("doc_id"), F.array_repeat(F.lit("dogs"), 50).alias("tokens")))
    table = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("never", "x")], "form string, lemma string")
    for words in (clean.GROUP_WORDS, 100):
        monkeypatch.setattr(clean, "GROUP_WORDS", words)
        joined = clean.lemmatize_by_join(many, "tokens", "out", table)
        assert joined.columns == ["doc_id", "tokens", "out"] and joined.count() == 405
        got = joined.where("doc_id is null or size(tokens) <> 50 or tokens is null").collect()
        expected = [(r[0], ["cat", "dog", "cat"] if r[0] == 1 else (r[1] or [])) for r in rows]
        assert sorted(((r.doc_id, r.out) for r in got), key=str) == sorted(expected, key=str)
        assert joined.where("size(tokens) = 50").select("out").distinct().collect() == [(["dog"] * 50,)]
    assert "Generate" not in joined._jdf.queryExecution().optimizedPlan().toString()
