"""Sinks: CSV for exchange, Parquet between stages, artifact tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.functions.text import joined
from jobsift.session import shuffles_dropped
from jobsift.sources.tables import CSV_OPTIONS

log = logging.getLogger(__name__)


def flat(df: DataFrame) -> DataFrame:
    """Arrays of strings become ``", "``-joined text, as CSV has no arrays."""
    is_list = {f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    return df.select(
        *[joined(F.col(c)).alias(c) if c in is_list else F.col(c) for c in df.columns]
    )


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 with header; null and empty text are both written as nothing."""
    flat(df).write.mode("overwrite").options(**CSV_OPTIONS, emptyValue="").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """A table in the denser codec; the shuffle files of the write go at its end, and those of earlier plans nobody holds."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    # counts on the way leave theirs until the driver collects its garbage, which may be never
    df.sparkSession._jvm.System.gc()


def write_raw_postings(df: DataFrame, path: str) -> bool:
    """Write collected postings; warn and write nothing when there are none."""
    if df.isEmpty():
        log.warning("no postings to save")
        return False
    write_csv(df, path)
    return True


def write_tfidf(weights: DataFrame, vocabulary: DataFrame, path: str) -> None:
    """Sparse matrix as (doc_id, term_id, tfidf) rows, vocabulary as a table."""
    write_parquet(weights.select("doc_id", "term_id", "tfidf"), f"{path}/tfidf_features")
    write_parquet(vocabulary.select("term_id", "term", "idf"), f"{path}/tfidf_vocab")


def write_vocabulary_json(vocabulary: DataFrame, path: str) -> None:
    """Vocabulary as JSON lines in UTF-8, one term per line with its column id."""
    vocabulary.select("term_id", "term", "idf").write.mode("overwrite").json(path)


def write_confusion(matrix: DataFrame, labels: DataFrame, path: str) -> None:
    """Confusion matrix in long form and the label order."""
    write_parquet(matrix, f"{path}/confusion_matrix")
    one_per_line = labels.agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("label_idx", "label"))),
                lambda x: x["label"],
            ),
            "\n",
        ).alias("value")
    )
    one_per_line.write.mode("overwrite").text(f"{path}/labels_order")
