"""Scans: postings, stored pages, label order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.sources import split_csv

POSTING_COLUMNS = [
    "titulo",
    "empresa",
    "tipo_emprego",
    "localizacao",
    "data_publicacao",
    "descricao_texto",
    "link",
    "origem",
    "data_coleta",
]

POSTING_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in POSTING_COLUMNS]
)

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def require_columns(df: DataFrame, *names: str, any_of: bool = False) -> None:
    """Fail at plan time when a column is missing; the message lists what exists."""
    present = [name for name in names if name in df.columns]
    if (any_of and present) or len(present) == len(names):
        return
    missing = [name for name in names if name not in df.columns]
    raise ValueError(f"Missing column(s) {missing}. Available columns: {df.columns}")


def read_postings_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = POSTING_SCHEMA,
    text_col: str = "descricao_texto",
    key: str = "doc_id",
    split: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """Header CSV with quoted line breaks; an empty field is null.

    Columns are bound by name: those of ``schema`` come first, with its types
    and null where the file lacks them, then all others as text.  A value that
    does not fit its type is null.  A file without the text column is an error,
    as are files with different headers.  Without a key column the key is a
    64-bit hash of the link, or of all fields where the link is empty.

    A file is one task's work unless ``split`` is given: then many tasks read a file
    (of about ``split_bytes`` each), which needs quotes to be doubled inside fields.
    """
    if split:
        raw = split_csv.read(spark, path, CSV_OPTIONS, split_bytes)
    else:
        raw = spark.read.options(**CSV_OPTIONS, enforceSchema="false").csv(path)
    require_columns(raw, text_col)

    def bound(field: T.StructField) -> Column:
        if field.name in raw.columns:
            return F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)
        if field.name == key:
            every = F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns])
            links = F.when(F.col("link").isNotNull(), F.xxhash64("link")) if "link" in raw.columns else F.lit(None)
            return F.coalesce(links, every).cast(field.dataType).alias(key)
        return F.lit(None).cast(field.dataType).alias(field.name)

    others = [F.col(f"`{c}`") for c in raw.columns if c not in schema.names]
    return raw.select(*[bound(field) for field in schema], *others)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """Parquet postings: the hand-over format between stages."""
    return spark.read.parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored web pages ``(page_id, url, html)``; a null html is a failed fetch."""
    return spark.read.parquet(path)


def read_label_order(spark: SparkSession, path: str) -> DataFrame:
    """Labels of a text file, one per line, blank lines skipped, in file order."""
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(
        F.filter(
            F.transform(F.split("value", "\n"), lambda x: F.trim(x)), lambda x: x != ""
        ).alias("labels")
    )
    return lines.select(F.posexplode("labels").alias("label_idx", "label"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a table that has fewer input splits than there are cores.

    A large table has many splits and is returned as it is; a small one in a
    single file would otherwise keep one core busy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df if splits >= cores else df.repartition(cores, key)


def first_rows(df: DataFrame, n: int | None, key: str = "doc_id") -> DataFrame:
    """The first ``n`` rows by key; no limit when ``n`` is 0 or None."""
    return df.orderBy(key).limit(n) if n else df
