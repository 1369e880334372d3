"""What a task holds at a time, and counts that stay where they are read."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from jobsift.functions.arrays import slices
from jobsift.functions.stem import stemmed
from jobsift.operators import tfidf


def test_slices_hold_a_limit_or_one_row():
    assert list(slices(np.array([3, 3, 9, 0, 1, 5]), 6)) == [(0, 2), (2, 3), (3, 6)]
    assert list(slices(np.zeros(0, np.int64), 6)) == []


def test_counts_of_rows_with_own_keys_do_not_move(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb"), (3, None), (4, "")], "doc_id long, text string")
    counted = tfidf.term_counts(docs, "text")
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, counted.collect())) == [(1, "aa", 2), (1, "aa bb", 1), (1, "bb", 1), (1, "bb aa", 1), (2, "bb", 1)]


def test_counts_of_shared_keys_are_summed(spark):
    rows = [(1, "aa bb"), (2, "bb"), (2, "bb cc"), (None, "aa"), (None, "aa")]
    counted = tfidf.term_counts(spark.createDataFrame(rows, "doc_id long, text string"), "text").collect()
    expected = [(1, "aa", 1), (1, "aa bb", 1), (1, "bb", 1), (2, "bb", 2), (2, "bb cc", 1), (2, "cc", 1), (None, "aa", 2)]
    assert sorted(map(repr, map(tuple, counted))) == sorted(map(repr, expected))


def test_stems_of_more_words_than_are_kept(spark):
    n = 300_000
    words = spark.range(3).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), i, F.lit("ings"))).alias("w"))
    found = words.coalesce(1).select(F.size(stemmed(F.col("w"))).alias("n"), F.get(stemmed(F.col("w")), F.lit(0)).alias("s")).collect()
    assert [tuple(r) for r in found] == [(n, stemmed_once())] * 3


def stemmed_once():
    from jobsift.functions.stem import porter

    return porter("w1ings")


def test_pairs_are_weighed_by_the_codes_of_their_words(spark):
    rows = [(1, "aa bb aa bb cc"), (2, "bb aa"), (3, "cc bb"), (4, None), (5, ""), (6, "dd"), (6, "aa bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    vocab = spark.createDataFrame(
        [(0, "aa", 1.0), (1, "aa bb", 2.0), (2, "bb", 1.5), (3, "bb aa", 1.0), (4, "bb  cc", 1.0), (5, "zz aa", 1.0), (6, "dd aa", 3.0)],
        "term_id int, term string, idf double",
    )
    made = tfidf.tfidf(docs, vocab, 7, "text")
    assert "zip_with" not in made._jdf.queryExecution().analyzed().toString()  # pairs as text stay unmade
    expected = [
        (1, 0, "aa", 2), (1, 1, "aa bb", 2), (1, 2, "bb", 2), (1, 3, "bb aa", 1), (2, 0, "aa", 1), (2, 2, "bb", 1),
        (2, 3, "bb aa", 1), (3, 2, "bb", 1), (6, 0, "aa", 1), (6, 1, "aa bb", 1), (6, 2, "bb", 1),
    ]
    found = sorted(map(tuple, made.collect()))
    assert [r[:4] for r in found] == expected
    lengths = {}
    for doc, *_, weight in found:
        lengths[doc] = lengths.get(doc, 0) + weight**2
    assert all(abs(x - 1) < 1e-12 for x in lengths.values())
    joined = tfidf._tfidf_by_join(docs, vocab, "text", "doc_id").collect()
    assert [(*r[:4], round(r[4], 9)) for r in found] == [(*r[:4], round(r[4], 9)) for r in sorted(map(tuple, joined))]


def test_totals_of_a_slice_need_one_sort(monkeypatch):
    lists = pa.array([["bb", "aa", "bb", "aa"], [], ["aa"], ["bb", "aa"], ["cc"]], pa.list_(pa.string()))
    monkeypatch.setattr(np, "unique", None)  # sorted each occurrence again, by document and term
    for part in (lists, lists.slice(1, 3), lists.slice(0, 0)):
        expected = {}
        for document in part.to_pylist():
            terms = [*document, *(f"{a} {b}" for a, b in zip(document, document[1:], strict=False))]
            for term in terms:
                cf, df = expected.get(term, (0, 0))
                expected[term] = (cf + 1, df)
            for term in set(terms):
                expected[term] = (expected[term][0], expected[term][1] + 1)
        terms, cf, df = tfidf._slice_totals(part)
        assert dict(zip(terms.to_pylist(), zip(cf.tolist(), df.tolist(), strict=True), strict=True)) == expected
