"""The shipped and the joined side of a lookup agree, with null and repeated keys."""

from pyspark.sql import functions as F

from jobsift.operators import annotate, clean, report, tfidf

ROWS = [(1, ["cats", "x"]), (1, ["dogs"]), (None, ["cats"]), (None, []), (2, ["y"])]


def test_lemmas_joined_equal_shipped(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "form string, lemma string")
    shipped = clean.map_tokens(docs, "tokens", "out", lemmas)
    joined = clean.lemmatize_by_join(docs, "tokens", "out", clean.one_lemma_per_form(lemmas))
    rows = lambda df: sorted((repr(r.doc_id), r.tokens, r.out) for r in df.collect())
    assert rows(shipped) == rows(joined)
    assert joined.columns == ["doc_id", "tokens", "out"]


def test_entities_joined_equal_shipped(spark, monkeypatch):
    texts = [(1, "Acme hires."), (1, "We left Acme Corp today."), (None, "Acme again."), (None, "Nobody.")]
    docs = spark.createDataFrame(texts, "doc_id long, descricao_texto string")
    entries = spark.createDataFrame([("Acme", "ORG"), ("Acme Corp", "ORG")], "surface string, label string")
    annotated = annotate.annotate(docs, "descricao_texto")
    names = lambda df: sorted(
        (r.descricao_texto, sorted((s["pos"], s["text"]) for s in r.spans if s["kind"] == "ENT")) for r in df.collect()
    )
    shipped = names(annotate.add_gazetteer_spans(annotated, entries))
    monkeypatch.setattr(annotate, "small_rows", lambda df: None)
    assert names(annotate.add_gazetteer_spans(annotated, entries)) == shipped
    assert any(found for _, found in shipped)


def test_word_pattern(spark):
    df = spark.createDataFrame([("m² area café a_b",)], "t string")
    words = df.select(F.regexp_extract_all("t", F.lit(tfidf.WORD_PATTERN), F.lit(0)).alias("w")).first().w
    assert words == ["m²", "area", "cafe", "a_b"]


def test_seniority_of_lists(spark):
    df = spark.createDataFrame([(1, ["Senior", "Jr"]), (2, []), (3, None)], "doc_id long, senioridade_re array<string>")
    got = {r.seniority: r.n for r in report.seniority_distribution(df).collect()}
    assert got == {"senior": 1, "Sem": 2}
