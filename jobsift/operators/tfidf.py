"""TF-IDF over words and word pairs, as a long table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobsift import limits
from jobsift.functions.arrays import let, one_row_per_item, slices
from jobsift.functions.text import text_of
from jobsift.limits import lookup_join
from jobsift.session import stored

WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Words that a task counts at a time, distinct terms it holds, and equal counts that one task ranks.
SLICE_WORDS = 1 << 20
# Terms that are weighed at a time
SLICE_TERMS = 1 << 18
HELD_TERMS = 1 << 20
RANKED_TERMS = 10_000
PREFIX_STEP = 2


def words_of(text: Column) -> Column:
    """Words of two characters and more in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def terms_of(text: Column) -> Column:
    """Words of two characters and more, followed by the pairs of neighbours."""
    words = words_of(text)

    def with_pairs(a: Column) -> Column:
        pairs = F.greatest(F.size(a) - 1, F.lit(0))
        neighbours = F.zip_with(
            F.slice(a, 1, pairs), F.slice(a, 2, pairs), lambda x, y: F.concat(x, F.lit(" "), y)
        )
        return F.concat(a, neighbours)

    return let(words, with_pairs)


def term_rows(docs: DataFrame, text_col: str, key: str = "doc_id") -> DataFrame:
    """(doc_id, term), one row per occurrence."""
    return one_row_per_item(docs, terms_of(text_of(text_col)), "term", key)


def term_counts(docs: DataFrame, text_col: str, key: str = "doc_id") -> DataFrame:
    """(doc_id, term, tf).

    A document whose key no other has is counted where it is read.  Only the
    terms of documents with a null or repeated key move, to be counted by key.
    """
    keys = docs.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = stored(keys.filter("_n > 1 OR _key IS NULL").select("_key"), "repeated-keys")
    if repeated.isEmpty():
        return _row_counts(docs, text_col, key)
    same = F.col(key).eqNullSafe(F.col("_key"))
    alone = docs.join(repeated, same, "left_anti")
    shared = term_rows(docs.join(repeated, same, "left_semi"), text_col, key).groupBy(key, "term")
    return _row_counts(alone, text_col, key).unionByName(shared.agg(F.count(F.lit(1)).alias("tf")))


def _row_counts(docs: DataFrame, text_col: str, key: str) -> DataFrame:
    """(doc_id, term, tf) of each row by itself."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(pc.list_value_length(batch.column(1)).to_numpy(), SLICE_TERMS):
                part = batch.slice(low, high - low)
                coded = part.column(1).flatten().dictionary_encode()
                n = max(len(coded.dictionary), 1)
                document = pc.list_parent_indices(part.column(1)).to_numpy().astype("int64")
                pairs, tf = np.unique(document * n + coded.indices.to_numpy(), return_counts=True)
                document, term = np.divmod(pairs, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(document)), coded.dictionary.take(pa.array(term)), pa.array(tf.astype("int64"))],
                    [key, "term", "tf"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, term_lists(text_col).alias("terms")).mapInArrow(count, f"`{key}` {kind}, term string, tf long")


def term_frequencies(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, df, cf): documents with the term and occurrences in the corpus.

    Both counts come from one pass: every occurrence counts for ``cf`` and every
    distinct term of a document once more for ``df``.  Partial sums on the map
    side keep a term that is in every document cheap.
    """
    terms = terms_of(text_of(text_col))
    both = docs.select(terms.alias("terms")).select(
        F.posexplode(F.array(F.col("terms"), F.array_distinct("terms"))).alias("is_df", "terms")
    )
    flat = one_row_per_item(both, F.col("terms"), "term", "is_df")
    return flat.groupBy("term").agg(
        F.sum("is_df").alias("df"), F.sum(1 - F.col("is_df")).alias("cf")
    )


def _code_totals(code: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes in order, with their occurrences and documents; documents are in order."""
    order = np.argsort(code, kind="stable")
    code, document = code[order], document[order]
    other = np.r_[True, code[1:] != code[:-1]] if len(code) else np.zeros(0, bool)
    starts = np.flatnonzero(other)
    other[1:] |= document[1:] != document[:-1]
    documents = np.add.reduceat(other, starts, dtype="int64") if len(starts) else starts
    return code[starts], np.diff(np.append(starts, len(code))), documents


def _slice_totals(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of some documents with their occurrences and documents."""
    coded = lists.flatten().dictionary_encode()
    words, n = coded.dictionary, max(len(coded.dictionary), 1)
    word = coded.indices.to_numpy().astype("int64")
    document = pc.list_parent_indices(lists).to_numpy().astype("int64")
    neighbours = np.flatnonzero(document[1:] == document[:-1])
    # every word of the dictionary occurs, so codes of words come out as they are
    _, occurrences, documents = _code_totals(word, document)
    pairs, pair_occurrences, pair_documents = _code_totals(word[neighbours] * n + word[neighbours + 1], document[neighbours])
    first, second = np.divmod(pairs, n)
    joined = pc.binary_join_element_wise(words.take(pa.array(first)), words.take(pa.array(second)), " ")
    return (
        pa.concat_arrays([words, joined.cast(words.type)]),
        np.concatenate([occurrences, pair_occurrences]),
        np.concatenate([documents, pair_documents]),
    )


def _partial_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: partly summed (term, cf, df), and the number of documents as the df of a null term."""
    names = ["term", "cf", "df"]
    held: list[pa.Table] = []
    size = n_docs = 0

    def summed() -> pa.Table:
        found = pa.concat_tables(held).group_by("term").aggregate([("cf", "sum"), ("df", "sum")])
        return found.select(["term", "cf_sum", "df_sum"]).rename_columns(names)

    for batch in batches:
        lists = batch.column(0)
        n_docs += len(lists)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        at = 0
        while at < len(lists):
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + SLICE_WORDS, "right")), at + 1)
            held.append(pa.table(list(_slice_totals(lists.slice(at, to - at))), names=names))
            size += len(held[-1])
            at = to
            if size > HELD_TERMS:
                held = [summed()]
                size = len(held[0])
                if size > HELD_TERMS // 2:
                    yield from held[0].combine_chunks().to_batches(max_chunksize=1 << 16)
                    held, size = [], 0
    if held:
        yield from summed().combine_chunks().to_batches(max_chunksize=1 << 16)
    nothing = pa.array([None], pa.string())
    yield pa.RecordBatch.from_arrays([nothing, pa.array([0], pa.int64()), pa.array([n_docs], pa.int64())], names)


def term_totals(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, cf, df) of all terms, and one row with a null term and the number of documents as df.

    Both counts come from one scan.  A task counts whole batches by word codes and
    sends each of its distinct terms once or a few times.
    """
    words = docs.select(word_lists(text_col).alias("words"))
    parts = words.mapInArrow(_partial_totals, "term string, cf long, df long")
    return parts.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def _last_of_first(rows: DataFrame, column: str, k: int) -> str:
    """The k-th smallest of distinct texts.

    Counts per prefix find the prefix that holds it, then longer prefixes within that one,
    until few enough are left to rank.  One row reaches the driver each time.
    """
    prefix, length = "", 0
    while True:
        inside = rows.filter(F.col(column).startswith(prefix))
        if inside.count() <= RANKED_TERMS:
            ranked = inside.select(column, F.row_number().over(W.orderBy(column)).alias("place"))
            return ranked.filter(F.col("place") == k).first()[column]
        length += PREFIX_STEP
        counted = inside.groupBy(F.substring(column, 1, length).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        upto = counted.withColumn("upto", F.sum("n").over(W.orderBy("prefix")))
        row = upto.filter(F.col("upto") >= k).agg(F.min_by(F.struct("prefix", "n", "upto"), "upto").alias("r")).first()["r"]
        prefix, k = row["prefix"], k - (row["upto"] - row["n"])
        if len(prefix) < length:  # shorter than asked for: a whole text, and texts are distinct
            return prefix


def most_frequent(totals: DataFrame, max_features: int) -> DataFrame:
    """The rows of the ``max_features`` largest counts, ties by the term.

    A histogram of the counts finds the count at which the vocabulary is full.  What is
    above it is kept as it is; only the terms with just that count are ranked, and
    neither is sorted as a whole.  ``totals`` is read several times.
    """
    histogram = totals.groupBy("cf").agg(F.count(F.lit(1)).alias("n"))
    # one row per distinct count, some square root of the words of the corpus
    upto = histogram.withColumn("upto", F.sum("n").over(W.orderBy(F.desc("cf"))))
    full = upto.filter(F.col("upto") >= max_features).agg(F.max_by(F.struct("cf", "n", "upto"), "cf").alias("r")).first()["r"]
    if full is None:
        return totals
    at_cut = totals.filter(F.col("cf") == full["cf"])
    if full["upto"] == max_features:
        return totals.filter(F.col("cf") >= full["cf"])
    last = _last_of_first(at_cut, "term", max_features - (full["upto"] - full["n"]))
    return totals.filter((F.col("cf") > full["cf"]) | ((F.col("cf") == full["cf"]) & (F.col("term") <= last)))


def vocabulary(docs: DataFrame, text_col: str, max_features: int) -> DataFrame:
    """(term_id, term, cf, df, idf) of the ``max_features`` most frequent terms.

    Ids follow alphabetic order.  The corpus is read once; its distinct terms are written
    with their counts, as finding the cut reads them several times.
    """
    totals = stored(term_totals(docs, text_col), "term-totals")
    n_docs = totals.filter("term IS NULL").first()["df"]
    kept = most_frequent(totals.filter("term IS NOT NULL"), max_features)
    smooth_idf = F.log((F.lit(n_docs) + 1) / (F.col("df") + 1)) + 1
    # at most max_features rows reach this window
    ids = F.row_number().over(W.orderBy("term")) - 1
    return kept.select(ids.alias("term_id"), "term", "cf", "df", smooth_idf.alias("idf"))


@dataclass
class Weights:
    """A vocabulary as arrays, to weigh the documents of a batch."""

    terms: pa.Array
    ids: np.ndarray
    idf: np.ndarray

    @classmethod
    def of(cls, vocab: DataFrame) -> Weights:
        rows = vocab.select("term_id", "term", "idf").orderBy("term_id").collect()
        return cls(
            pa.array([r["term"] for r in rows], pa.string()),
            np.array([r["term_id"] for r in rows], dtype="int32"),
            np.array([r["idf"] for r in rows], dtype="float64"),
        )

    def __post_init__(self) -> None:
        halves = [t.split(" ", 1) for t in self.terms.to_pylist()]
        self.pairs = np.array([i for i, h in enumerate(halves) if len(h) == 2], dtype="int64")
        self.first = pa.array([halves[i][0] for i in self.pairs], pa.string())
        self.second = pa.array([halves[i][1] for i in self.pairs], pa.string())

    def _places(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Document and place in the vocabulary of each known word, then of each known pair of neighbours."""
        coded = lists.flatten().dictionary_encode()
        words, word = coded.dictionary, coded.indices.to_numpy().astype("int64")
        document = pc.list_parent_indices(lists).to_numpy().astype("int64")
        single = pc.fill_null(pc.index_in(words, value_set=self.terms), -1).to_numpy().astype("int64")[word]
        n = max(len(words), 1)
        first, second = (
            pc.fill_null(pc.index_in(half, value_set=words), -1).to_numpy().astype("int64") for half in (self.first, self.second)
        )
        occurring = np.flatnonzero((first >= 0) & (second >= 0))
        keys = first[occurring] * n + second[occurring]
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], self.pairs[occurring[order]]
        neighbours = np.flatnonzero(document[1:] == document[:-1])
        wanted = word[neighbours] * n + word[neighbours + 1]
        at = np.searchsorted(keys, wanted)
        found = np.flatnonzero(np.append(keys, -1)[at] == wanted)
        known = single >= 0
        return (
            np.concatenate([document[known], document[neighbours[found]]]),
            np.concatenate([single[known], places[at[found]]]),
        )

    def count(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, place in the vocabulary and count of each known term, by document and term; length of each document.

        ``lists`` are the words of each document; pairs of neighbours are found by the codes of their words.
        """
        document, term = self._places(lists)
        pairs, tf = np.unique(document * max(len(self.ids), 1) + term, return_counts=True)
        document, term = np.divmod(pairs, max(len(self.ids), 1))
        weight = tf * self.idf[term]
        return document, term, tf, np.sqrt(np.bincount(document, weight * weight, minlength=len(lists)))

    def weigh(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, place in the vocabulary, count and weight of each known term, by document and term."""
        document, term, tf, length = self.count(lists)
        return document, term, tf, tf * self.idf[term] / length[document]


def term_lists(text_col: str) -> Column:
    """The terms of a text, an empty list for none."""
    return F.coalesce(terms_of(text_of(text_col)), F.array().cast("array<string>"))


def word_lists(text_col: str) -> Column:
    """The words of a text, an empty list for none."""
    return F.coalesce(words_of(text_of(text_col)), F.array().cast("array<string>"))


def tfidf(
    docs: DataFrame,
    vocab: DataFrame,
    max_features: int,
    text_col: str,
    key: str = "doc_id",
) -> DataFrame:
    """(doc_id, term_id, term, tf, tfidf) with rows of unit length.

    Also the transform of unseen documents: terms outside the vocabulary are
    dropped.  A vocabulary of at most ``MAX_BROADCAST_ROWS`` terms, a bound that
    ``max_features`` proves, travels with the tasks; each document is then counted
    where it is read and nothing shuffles.  Every row of ``docs`` is a document of
    its own, also with a null or repeated key.
    """
    if max_features > limits.MAX_BROADCAST_ROWS:
        return _tfidf_by_join(docs, vocab, text_col, key)
    shipped = docs.sparkSession.sparkContext.broadcast(Weights.of(vocab))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shipped.value
        for batch in batches:
            # words are half of the terms
            for low, high in slices(pc.list_value_length(batch.column(1)).to_numpy(), SLICE_TERMS // 2):
                part = batch.slice(low, high - low)
                document, term, tf, weight = vocabulary.weigh(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(document)),
                        pa.array(vocabulary.ids[term]),
                        vocabulary.terms.take(pa.array(term)),
                        pa.array(tf.astype("int64")),
                        pa.array(weight),
                    ],
                    [key, "term_id", "term", "tf", "tfidf"],
                )

    kind = docs.schema[key].dataType.simpleString()
    words = docs.select(key, word_lists(text_col).alias("words"))
    return words.mapInArrow(weigh, f"`{key}` {kind}, term_id int, term string, tf long, tfidf double")


def _tfidf_by_join(docs: DataFrame, vocab: DataFrame, text_col: str, key: str) -> DataFrame:
    """The same table for a vocabulary of any size.

    Rows are told apart by an id written with them once; the counts meet by it.
    """
    rows = stored(docs.select(key, text_col, F.monotonically_increasing_id().alias("_row")), "tfidf-rows")
    known = vocab.select("term", "term_id", "idf")
    counted = term_rows(rows, text_col, "_row").groupBy("_row", "term").agg(F.count(F.lit(1)).alias("tf"))
    matched = lookup_join(counted, known, "term", F.col("_row"))
    weighted = matched.withColumn("w", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("_row")))
    return (
        weighted.withColumn("tfidf", F.col("w") / length)
        .join(rows.select("_row", key), "_row")
        .select(key, "term_id", "term", "tf", "tfidf")
    )


def build_tfidf(
    docs: DataFrame, text_col: str, max_features: int, key: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """Matrix and vocabulary of a corpus.

    The vocabulary is written once, as the matrix and its reader both need it.
    """
    vocab = stored(vocabulary(docs, text_col, max_features), "vocabulary")
    return tfidf(docs, vocab, max_features, text_col, key), vocab
