import pytest
from pyspark.sql import functions as F

from jobsift.plans import chain, views
from jobsift.session import checkpoint_dir
from jobsift.sources import sinks, tables
from jobsift.streaming import rows as stream


def test_csv_round_trip(spark, tmp_path):
    values = [(1, 'say "hi", you\nnext', None), (2, "", "  padded "), (3, "é, ü", "x")]
    df = spark.createDataFrame(values, "doc_id long, descricao_texto string, titulo string")
    path = str(tmp_path / "csv")
    sinks.write_csv(df, path)
    back = tables.read_postings_csv(spark, path, df.schema).orderBy("doc_id").collect()
    assert [tuple(r) for r in back] == [
        (1, 'say "hi", you\nnext', None), (2, None, "  padded "), (3, "é, ü", "x"),
    ]


def test_csv_sink_joins_lists(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "doc_id long, v array<string>")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().v == "a, b"


def test_label_order_skips_blank_lines(spark, tmp_path):
    (tmp_path / "labels.txt").write_text("Dados\n\n  Backend \nOutro\n", encoding="utf-8")
    got = tables.read_label_order(spark, str(tmp_path / "labels.txt")).collect()
    assert [tuple(r) for r in got] == [(0, "Dados"), (1, "Backend"), (2, "Outro")]


def test_first_rows(spark):
    df = spark.range(10).select((9 - F.col("id")).alias("doc_id"))
    assert [r.doc_id for r in tables.first_rows(df, 3).collect()] == [0, 1, 2]
    assert tables.first_rows(df, 0).count() == 10


def test_checkpoint_dir_comes_from_the_session(spark, tmp_path):
    assert checkpoint_dir(spark)
    spark.conf.set("spark.checkpoint.dir", str(tmp_path)) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    if spark.conf.isModifiable("spark.checkpoint.dir"):
        assert checkpoint_dir(spark) == str(tmp_path)
        spark.conf.unset("spark.checkpoint.dir")


def test_whole_chain(spark, sf_dir, tmp_path):
    postings = views.postings(spark, sf_dir)
    cfg = chain.Config(
        out_dir=str(tmp_path), max_features=200, model_max_features=300, model_max_iter=20, text_source="raw"
    )
    got = chain.run(spark, postings, cfg)
    n = postings.count()
    assert got["labeled"].count() == n
    assert got["vocabulary"].count() == 200
    assert got["confusion"].agg(F.sum("n")).first()[0] == got["predictions"].count()
    assert [r.true_label for r in got["confusion_grid"].collect()][:2] == ["Dados", "Backend"]
    assert got["top_skills"].count() > 5 and got["skill_pairs"].count() == 10
    assert set(chain.summary(got).toPandas().result) == set(got)
    for c in ["senioridade_re", "spacy_tokens", "text_clean", "adv_top_pos", "label_area"]:
        assert c in got["labeled"].columns


def test_chain_needs_the_text_column(spark):
    with pytest.raises(ValueError):
        chain.run(spark, spark.range(1).withColumnRenamed("id", "doc_id"))


def test_stream_gives_the_batch_result(spark, sf_dir, tmp_path):
    full = views.postings(spark, sf_dir)
    for name in tables.POSTING_COLUMNS:
        if name not in full.columns:
            full = full.withColumn(name, F.lit(None).cast("string"))
    full.select(*tables.POSTING_SCHEMA.names).write.parquet(str(tmp_path / "in"))
    query = stream.write_stream(
        stream.enrich_stream(stream.read_posting_stream(spark, str(tmp_path / "in"))),
        str(tmp_path / "out"), str(tmp_path / "cp"),
    )
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    expected = stream.enrich_stream(spark.read.parquet(str(tmp_path / "in")))
    assert got.exceptAll(expected).isEmpty() and got.count() == expected.count()


def test_csv_is_bound_by_name(spark, tmp_path):
    path = str(tmp_path / "layout")
    rows = [("7 lines\nlong", "Dev", "x", "l1"), ("b", None, "y", "l2"), ("c", "QA", None, None)]
    df = spark.createDataFrame(rows, "descricao_texto string, titulo string, extra string, link string")
    sinks.write_csv(df, path)
    back = tables.read_postings_csv(spark, path)
    assert back.columns == [*tables.POSTING_SCHEMA.names, "extra"]
    got = back.orderBy("descricao_texto").collect()
    assert [(r.descricao_texto, r.titulo, r.extra, r.link, r.empresa) for r in got] == [
        (text, title, extra, link, None) for text, title, extra, link in rows
    ]
    assert len({r.doc_id for r in got}) == 3 and all(r.doc_id is not None for r in got)
    again = tables.read_postings_csv(spark, path).orderBy("descricao_texto").collect()
    assert [r.doc_id for r in again] == [r.doc_id for r in got]


def test_csv_without_text_is_an_error(spark, tmp_path):
    path = str(tmp_path / "other")
    spark.createDataFrame([("a",)], "titulo string").write.option("header", "true").csv(path)
    with pytest.raises(ValueError, match="descricao_texto"):
        tables.read_postings_csv(spark, path)
