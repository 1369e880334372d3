import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobsift import limits
from jobsift.functions.stem import porter
from jobsift.functions.text import normalized, word_tokens
from jobsift.operators import clean, tfidf


def test_normalized(spark):
    df = spark.createDataFrame([("Café at http://x.y is GREAT!!",), ("",), ("ÀB\n\tc",)], "t string")
    assert [r[0] for r in df.select(normalized(F.col("t"))).collect()] == ["caf at is great", "", "b c"]


def test_contractions_become_two_words(spark):
    df = spark.createDataFrame([("i cannot gonna cannots lemme",)], "t string")
    got = df.select(word_tokens(F.col("t"))).first()[0]
    assert got == ["i", "can", "not", "gon", "na", "cannots", "lem", "me"]


def test_content_tokens(texts):
    got = texts("a bb ccc", "the engineers and it", None).select(
        clean.tokens_of("descricao_texto").alias("t")
    )
    assert [r.t for r in got.collect()] == [["ccc"], ["engineers"], []]


@pytest.mark.parametrize(
    "word, stem",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("caress", "caress"),
        ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"),
        ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"),
        ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"),
        ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"),
        ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
        ("conditional", "condit"), ("valenci", "valenc"), ("digitizer", "digit"),
        ("radicalli", "radic"), ("vietnamization", "vietnam"), ("operator", "oper"),
        ("feudalism", "feudal"), ("hopefulness", "hope"), ("formaliti", "formal"),
        ("triplicate", "triplic"), ("formalize", "formal"), ("electrical", "electr"),
        ("goodness", "good"), ("revival", "reviv"), ("allowance", "allow"),
        ("inference", "infer"), ("adjustment", "adjust"), ("adoption", "adopt"),
        ("communism", "commun"), ("activate", "activ"), ("effective", "effect"),
        ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"),
        ("roll", "roll"), ("dying", "die"), ("news", "news"), ("enjoy", "enjoy"),
        ("machine", "machin"), ("learning", "learn"), ("engineer", "engin"),
        ("dies", "die"), ("spied", "spi"), ("died", "die"), ("analogy", "analog"),
        ("as", "as"), ("python3", "python3"), ("succeed", "succeed"),
    ],
)
def test_porter(word, stem):
    assert porter(word) == stem


def test_clean_text_keeps_every_row_and_order(texts):
    df = texts("Machine learning engineers at http://x.y", None, "the of", "data data pipelines")
    got = clean.clean_text(df).orderBy("doc_id").collect()
    assert [r.text_clean for r in got] == ["machin learn engin", "", "", "data data pipelin"]


def test_dictionary_paths_agree(spark, texts, monkeypatch):
    df = texts("wolves and mice chase geese", "mice mice mice", None).withColumn(
        "tokens", clean.tokens_of("descricao_texto")
    )
    lemmas = spark.createDataFrame(
        [("wolves", "wolf"), ("mice", "mouse"), ("geese", "goose"), ("mice", "zzz")],
        "form string, lemma string",
    )
    shipped = clean.map_tokens(df, "tokens", "out", lemmas).orderBy("doc_id").select("out").collect()
    assert [r.out for r in shipped] == [["wolf", "mouse", "chase", "goose"], ["mouse"] * 3, []]
    stemmed = clean.map_tokens(df, "tokens", "out", lemmas, stem=True).orderBy("doc_id").select("out")
    monkeypatch.setattr(clean, "small_rows", lambda frame: None)
    joined = clean.map_tokens(df, "tokens", "out", lemmas).orderBy("doc_id").select("out").collect()
    assert joined == shipped
    both = clean.map_tokens(df, "tokens", "out", lemmas, stem=True).orderBy("doc_id").select("out")
    assert both.collect() == stemmed.collect()


def test_small_rows_is_bounded(spark):
    assert limits.small_rows(spark.range(5), 4) is None
    assert len(limits.small_rows(spark.range(4), 4)) == 4


def test_terms_pair_neighbours_after_dropping_single_letters(spark):
    df = spark.createDataFrame([("big a Data set",), ("x",), ("one",), ("",)], "t string")
    got = [r[0] for r in df.select(tfidf.terms_of(F.col("t"))).collect()]
    assert got == [["big", "data", "set", "big data", "data set"], [], ["one"], []]


def docs(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, t string")


def test_idf_and_unit_rows(spark):
    corpus = docs(spark, "aa bb", "aa", "")
    corpus = corpus.filter("t <> ''")
    matrix, vocab = tfidf.build_tfidf(corpus, "t", 10)
    idf = {r.term: r.idf for r in vocab.collect()}
    assert idf["aa"] == pytest.approx(1.0)
    assert idf["bb"] == idf["aa bb"] == pytest.approx(math.log(3 / 2) + 1)
    norms = matrix.groupBy("doc_id").agg(F.sum(F.col("tfidf") ** 2).alias("n")).collect()
    assert len(norms) == 2 and all(r.n == pytest.approx(1.0) for r in norms)
    ids = {r.term: r.term_id for r in vocab.collect()}
    assert [t for t, _ in sorted(ids.items(), key=lambda x: x[1])] == sorted(ids)


def test_vocabulary_cap_and_ties(spark):
    vocab = tfidf.vocabulary(docs(spark, "cc cc bb aa", "bb aa"), "t", 3).collect()
    assert [(r.term_id, r.term, r.cf) for r in vocab] == [(0, "aa", 2), (1, "bb", 2), (2, "bb aa", 2)]


@pytest.mark.parametrize("ranked", [10_000, 2])
def test_vocabulary_cut_inside_equal_counts(spark, monkeypatch, ranked):
    """Most terms occur once, so the cut lies among them, whatever one task may rank."""
    monkeypatch.setattr(tfidf, "RANKED_TERMS", ranked)
    texts = ["alpha alphabet alphabets al", "beta alpha gamma", "été étés 日本 日本語 ab", "", None, "alpha beta"]
    counts, documents = Counter(), Counter()
    for text in texts:
        words = re.findall(r"\w{2,}", (text or "").lower())
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        counts.update(terms)
        documents.update(set(terms))
    ordered = sorted(counts, key=lambda t: (-counts[t], t.encode()))
    df = docs(spark, *texts).repartition(3)
    for k in (1, 3, 6, 9, 14, len(ordered) - 1, len(ordered), len(ordered) + 1):
        got = {r.term: (r.cf, r.df) for r in tfidf.vocabulary(df, "t", k).collect()}
        assert got == {t: (counts[t], documents[t]) for t in ordered[:k]}


def test_terms_held_by_a_task_are_bounded(spark, monkeypatch):
    texts = [" ".join(f"w{(i * 7 + j * j) % 90}" for j in range(40)) for i in range(30)]
    corpus = docs(spark, *texts).coalesce(1)
    whole = sorted(map(tuple, tfidf.term_totals(corpus, "t").collect()), key=repr)
    monkeypatch.setattr(tfidf, "SLICE_WORDS", 50)
    monkeypatch.setattr(tfidf, "HELD_TERMS", 100)
    assert sorted(map(tuple, tfidf.term_totals(corpus, "t").collect()), key=repr) == whole
    frequencies = {r.term: (r.cf, r.df) for r in tfidf.term_frequencies(corpus, "t").collect()}
    assert {r[0]: r[1:] for r in whole if r[0]} == frequencies


def test_vocabulary_has_no_ordered_limit(spark):
    vocab = tfidf.vocabulary(docs(spark, "cc cc bb aa", "bb aa"), "t", 3)
    plan = vocab._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan


def test_transform_drops_unknown_terms(spark):
    vocab = tfidf.vocabulary(docs(spark, "aa bb", "aa"), "t", 10)
    got = tfidf.tfidf(docs(spark, "aa zz", "qq"), vocab, 10, "t").collect()
    assert [(r.doc_id, r.term, r.tf, r.tfidf) for r in got] == [(0, "aa", 1, 1.0)]


def test_tfidf_without_broadcast_is_the_same(spark, sf_dir, monkeypatch):
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("t"))
    order = ["doc_id", "term_id"]
    small = [tuple(r) for r in tfidf.build_tfidf(corpus, "t", 200)[0].orderBy(*order).collect()]
    monkeypatch.setattr(limits, "MAX_BROADCAST_ROWS", 10)
    large = [tuple(r) for r in tfidf.build_tfidf(corpus, "t", 200)[0].orderBy(*order).collect()]
    assert [r[:4] for r in small] == [r[:4] for r in large]
    assert [r[4] for r in small] == pytest.approx([r[4] for r in large])


@pytest.mark.parametrize("limit", [200_000, 1])
def test_every_row_is_a_document_whatever_its_key(spark, monkeypatch, limit):
    rows = [(None, "aa bb"), (None, "aa"), (1, "aa aa"), (1, "bb"), (2, ""), (3, None)]
    corpus = spark.createDataFrame(rows, "doc_id long, t string")
    vocab = tfidf.vocabulary(docs(spark, "aa", "bb"), "t", 10)
    monkeypatch.setattr(limits, "MAX_BROADCAST_ROWS", limit)
    got = [(r.doc_id, r.term, r.tf, round(r.tfidf, 6)) for r in tfidf.tfidf(corpus, vocab, 10, "t").collect()]
    half = round(math.sqrt(0.5), 6)
    assert sorted(got, key=repr) == sorted(
        [(None, "aa", 1, half), (None, "bb", 1, half), (None, "aa", 1, 1.0), (1, "aa", 2, 1.0), (1, "bb", 1, 1.0)],
        key=repr,
    )


def test_an_empty_vocabulary_weighs_nothing(spark):
    vocab = tfidf.vocabulary(docs(spark, "", "x"), "t", 10)
    assert tfidf.tfidf(docs(spark, "aa", ""), vocab, 10, "t").collect() == []


def test_weighing_does_not_shuffle(spark, sf_dir):
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet")
    vocab = tfidf.vocabulary(docs(spark, "aa", "bb"), "t", 10)
    plan = tfidf.tfidf(corpus, vocab, 10, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
