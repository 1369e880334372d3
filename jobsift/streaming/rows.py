"""The stateless stages on a stream of new postings.

Feature extraction and labelling look at one row at a time, so the batch
functions are used as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobsift.operators import extract, label
from jobsift.sources.tables import POSTING_SCHEMA


def read_posting_stream(spark: SparkSession, path: str) -> DataFrame:
    """Parquet posting files that arrive in a folder."""
    return spark.readStream.schema(POSTING_SCHEMA).parquet(path)


def enrich_stream(postings: DataFrame, text_col: str = extract.TEXT_COL) -> DataFrame:
    return label.label_areas(extract.extract_features(postings, text_col), text_col)


def write_stream(enriched: DataFrame, path: str, checkpoint: str):
    """Append to Parquet, processing what is there and then stopping."""
    return (
        enriched.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
