import re

import pytest
from pyspark.sql import functions as F

from jobsift import limits
from jobsift.operators import annotate
from jobsift.plans import views

TEXT = "Acme Corp hires senior engineers. The engineers build data pipelines! Is it in New York?"


def gazetteer(spark):
    return spark.createDataFrame(
        [("Acme Corp", "ORG"), ("New York", "GPE"), ("York", "GPE"), ("senior", "LEVEL"), ("nowhere", "LOC")],
        "surface string, label string",
    )


def test_rule_based_summaries(spark, texts):
    done = annotate.summarize(annotate.annotate(texts(TEXT), gazetteer=gazetteer(spark))).first()
    assert (done.spacy_sentences, done.spacy_tokens) == (3, 18)
    assert done.adv_tokens_per_sentence == 6.0
    assert done.spacy_top_lemmas.split(", ")[0] == "engineers"
    assert (done.spacy_orgs, done.spacy_places, done.adv_other_ents) == (
        "Acme Corp", "New York, York", "senior(LEVEL)",
    )
    assert done.adv_top_pos.startswith("NOUN")
    assert "data pipelines" in done.adv_top_noun_chunks.split(", ") or "pipelines" in done.adv_top_noun_chunks


def test_empty_text(spark, texts):
    rows = annotate.summarize(
        annotate.annotate(texts(None, "", " \n "), gazetteer=gazetteer(spark))
    ).collect()
    for r in rows:
        assert (r.spacy_sentences, r.spacy_tokens, r.adv_sentences, r.adv_tokens) == (0, 0, 1, 0)
        assert r.adv_tokens_per_sentence == 0.0
        assert (r.spacy_top_lemmas, r.adv_top_pos, r.adv_top_noun_chunks, r.spacy_orgs) == ("",) * 4


def test_gazetteer_paths_agree(spark, sf_dir, monkeypatch):
    docs = views.postings(spark, sf_dir)
    words = (
        docs.select(F.explode(F.split("descricao_texto", r"\s+")).alias("surface"))
        .groupBy("surface").count().orderBy("count", "surface").limit(300)
        .select("surface", F.when(F.length("surface") % 2 == 0, "ORG").otherwise("LOC").alias("label"))
    ).unionByName(gazetteer(spark))
    annotated = annotate.annotate(docs)
    order = ["doc_id", "pos", "kind", "text"]
    shipped = annotate.span_rows(annotate.add_gazetteer_spans(annotated, words)).orderBy(*order).collect()
    assert any(r.kind == "ENT" for r in shipped)
    for limit in (limits.MAX_BROADCAST_ROWS, 10):
        monkeypatch.setattr(annotate, "small_rows", lambda frame: None)
        monkeypatch.setattr(limits, "MAX_BROADCAST_ROWS", limit)
        joined = annotate.span_rows(annotate.add_gazetteer_spans(annotated, words)).orderBy(*order)
        assert joined.collect() == shipped


def make_plain_annotator():
    """A factory that is pickled by value: executors do not have this module."""

    def plain_annotator():
        def run(texts):
            for text in texts:
                tokens, sent, pos = [], 0, 0
                for word, gap in re.findall(r"(\w+|[^\w\s])(\s*)", text):
                    tokens.append(
                        dict(sent=sent, pos=pos, text=word, lemma=word.lower(), upos="X",
                             is_space=False, is_alpha=word.isalpha(), is_stop=False)
                    )
                    pos += 1
                    sent += word in ".!?" and gap != ""
                yield tokens, []

        return run

    return plain_annotator


def test_plugged_annotator_agrees_with_the_rules(spark, sf_dir):
    docs = views.postings(spark, sf_dir)
    columns = ["doc_id", "sent", "pos", "text", "lemma", "is_alpha"]
    plugged = annotate.annotate(docs, factory=make_plain_annotator())
    rules = annotate.annotate(docs)
    a = annotate.token_rows(plugged).select(*columns)
    b = annotate.token_rows(rules).select(*columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty()


def broken():
    raise ImportError("no such model")


def test_choose_annotator():
    plain = make_plain_annotator()
    assert annotate.choose_annotator(broken, plain) is plain
    assert annotate.choose_annotator(broken) is None


def test_caps_and_distinct(spark):
    spans = [dict(pos=i, kind="ENT", text=f" Org{i % 10} ", label="ORG") for i in range(40)]
    df = spark.createDataFrame([(1, spans)], f"doc_id long, spans {annotate.SPANS_TYPE}")
    got = df.select(
        annotate.entities(F.col("spans"), ["ORG"], 6).alias("six"),
        annotate.entities(F.col("spans"), ["ORG"], 8).alias("eight"),
    ).first()
    assert got.six == [f"Org{i}" for i in range(6)] and len(got.eight) == 8


def test_noun_chunk_length_bounds(spark):
    spans = [dict(pos=i, kind="NP", text=t, label="") for i, t in enumerate(["x", "Ab", "ab", "y" * 51, "z" * 50])]
    df = spark.createDataFrame([(1, spans)], f"doc_id long, spans {annotate.SPANS_TYPE}")
    assert df.select(annotate.top_noun_chunks(F.col("spans"))).first()[0] == ["ab", "z" * 50]


def test_missing_column(texts):
    with pytest.raises(ValueError):
        annotate.annotate(texts("a"), "nope")
