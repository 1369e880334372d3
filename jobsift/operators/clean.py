"""Normalise, tokenise, filter, lemmatise and stem the posting text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.functions.arrays import slices
from jobsift.functions.stem import map_words, porter
from jobsift.functions.text import content_tokens, normalized, text_of, word_tokens
from jobsift.limits import row_groups, small_rows
from jobsift.session import stored
from jobsift.sources.tables import require_columns

TEXT_COL = "descricao_texto"
# Words that a task sends to the dictionary at a time, and words of a group of rows on average
SLICE_WORDS = 1 << 18
GROUP_WORDS = 1 << 20


def tokens_of(text_col: str, stop_words: Sequence[str] | None = None) -> Column:
    """Content words of a text column, in order."""
    return content_tokens(word_tokens(normalized(text_of(text_col))), stop_words)


def one_lemma_per_form(lemmas: DataFrame) -> DataFrame:
    return (
        lemmas.filter(F.col("form").isNotNull() & F.col("lemma").isNotNull())
        .groupBy("form")
        .agg(F.min("lemma").alias("lemma"))
    )


def map_tokens(
    df: DataFrame,
    tokens_col: str,
    out_col: str,
    lemmas: DataFrame | None = None,
    stem: bool = False,
    key: str = "doc_id",
) -> DataFrame:
    """Replace each token by its dictionary form, then optionally by its stem.

    A dictionary of bounded size travels with the tasks and nothing shuffles.
    A larger one is joined to the distinct words of groups of rows.
    """
    ending = porter if stem else _same
    if lemmas is None:
        return df.withColumn(out_col, map_words(F.col(tokens_col), lambda: ending))
    dictionary = one_lemma_per_form(lemmas)
    rows = small_rows(dictionary)
    if rows is not None:
        shipped = df.sparkSession.sparkContext.broadcast({r["form"]: r["lemma"] for r in rows})

        def for_task():
            table = shipped.value
            return lambda word: ending(table.get(word, word))

        return df.withColumn(out_col, map_words(F.col(tokens_col), for_task))
    replaced = lemmatize_by_join(df, tokens_col, out_col, dictionary, key)
    if not stem:
        return replaced
    return replaced.withColumn(out_col, map_words(F.col(out_col), lambda: porter))


def _same(word: str) -> str:
    return word


def lemmatize_by_join(
    df: DataFrame, tokens_col: str, out_col: str, dictionary: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Dictionary forms by a distributed join, for dictionaries of any size.

    Rows are dealt into groups.  A group sends each of its words once, whatever its occurrences,
    these meet the dictionary, and the group gets back the entries of its words.  The rows move
    once, as they are, and their words are replaced behind that, in order.  Rows are told apart by an
    id written with them, so null and repeated keys are kept as they are.
    """
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "lemma-rows")
    grouped = row_groups(rows, F.coalesce(F.size(tokens_col), F.lit(0)), GROUP_WORDS)

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy()
            for low, high in slices(lengths, SLICE_WORDS):
                words, row, part = _listed(batch.slice(low, high - low), 1)
                found = pa.table({"_group": part.column(0).take(row), "form": words})
                yield from found.group_by(["_group", "form"]).aggregate([]).combine_chunks().to_batches()

    given, schema = df.columns, T.StructType([*rows.drop("_row").schema, T.StructField(out_col, T.ArrayType(T.StringType()))])
    at = given.index(tokens_col)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, lemmas = right["form"].combine_chunks(), right["lemma"].combine_chunks()
        parts = []
        for batch in left.select(given).to_batches():
            words, row, _ = _listed(batch, at)
            coded = words.dictionary_encode()
            replaced = pc.coalesce(lemmas.take(pc.index_in(coded.dictionary, value_set=known)), coded.dictionary)
            offsets = np.zeros(len(batch) + 1, np.int32)
            np.cumsum(np.bincount(row.to_numpy(), minlength=len(batch)), out=offsets[1:])
            parts.append(pa.ListArray.from_arrays(pa.array(offsets), replaced.take(coded.indices)))
        return left.select(given).append_column(out_col, pa.chunked_array(parts, pa.list_(pa.string())))

    words = grouped.select("_group", F.col(tokens_col).alias("words")).mapInArrow(forms, "_group long, form string")
    pieces = words.join(dictionary, "form").select("_group", "form", "lemma")
    moved = grouped.drop("_row")
    return moved.groupBy("_group").cogroup(pieces.groupBy("_group")).applyInArrow(run, schema)


def _listed(batch: pa.RecordBatch, at: int) -> tuple[pa.Array, pa.Array, pa.RecordBatch]:
    """Words of a list column but the null ones, and the row of each."""
    lists = batch.column(at)
    words, row = lists.flatten(), pc.list_parent_indices(lists)
    if words.null_count:
        valid = words.is_valid()
        words, row = words.filter(valid), row.filter(valid)
    return words, row, batch


def clean_text(
    df: DataFrame,
    text_col: str = TEXT_COL,
    lemmas: DataFrame | None = None,
    stop_words: Sequence[str] | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Append ``text_clean``: stems of the content words joined by a blank."""
    require_columns(df, text_col)
    tokens = df.withColumn("_tokens", tokens_of(text_col, stop_words))
    stems = map_tokens(tokens, "_tokens", "_stems", lemmas, stem=True, key=key)
    return stems.withColumn("text_clean", F.array_join("_stems", " ")).drop("_tokens", "_stems")
