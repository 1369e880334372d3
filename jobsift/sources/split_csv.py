"""CSV files with quoted line breaks, read by many tasks per file.

A line break belongs to a field where an odd number of quotes precede it in the file.
The quotes of every input split are counted in parallel; the sums of one number per
split tell whether a split starts inside a field.  With that, each split's lines are put
together to records where they are read.  Only a record that crosses splits leaves two
or more fragments, which are joined by their order.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsift.session import stored

SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
# Kinds of what a split emits
WHOLE, HEAD, TAIL = 0, 1, 2
_PIECE = "file string, start long, kind int, first boolean, record string"


@contextmanager
def _split_size(spark: SparkSession, size: int | None) -> Iterator[None]:
    before = spark.conf.get(SPLIT_BYTES)
    if size is not None:
        spark.conf.set(SPLIT_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_BYTES, before)


def _pieces(inside_at: dict[tuple[str, int], bool]):
    """Records of each split; its open ends as fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: tuple[str, int] | None = None
        kind, first, inside = WHOLE, False, False
        open_lines: list[str] = []

        def piece(records: list[str], kinds: list[int], firsts: list[bool]) -> pa.RecordBatch:
            file, start = split
            n = len(records)
            columns = [pa.array([file] * n, pa.string()), pa.array([start] * n, pa.int64())]
            columns += [pa.array(kinds, pa.int32()), pa.array(firsts, pa.bool_()), pa.array(records, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["file", "start", "kind", "first", "record"])

        def closed() -> Iterator[pa.RecordBatch]:
            """What is open at the end of a split: whole if its quotes are even, and a fragment if not."""
            if open_lines:
                ended = kind if kind == HEAD else (TAIL if inside else WHOLE)
                yield piece(["\n".join(open_lines)], [ended], [first])

        for batch in batches:
            lines, files, starts = (batch.column(i) for i in range(3))
            if not batch.num_rows:
                continue
            at = starts.to_numpy()
            changes = np.flatnonzero(at[1:] != at[:-1]) + 1
            if len(pc.unique(files)) > 1:
                names = files.dictionary_encode().indices.to_numpy()
                changes = np.union1d(changes, np.flatnonzero(names[1:] != names[:-1]) + 1)
            for low, high in zip([0, *changes], [*changes, batch.num_rows]):
                own = (files[int(low)].as_py(), int(at[low]))
                if own != split:
                    yield from closed()
                    split, inside, open_lines = own, inside_at[own], []
                    kind, first = (HEAD, False) if inside else (WHOLE, own[1] == 0)
                part = lines.slice(low, high - low)
                quotes = pc.count_substring(part, '"').to_numpy()
                odd = (np.cumsum(quotes) + inside) % 2 == 1
                begins = ~np.concatenate([[inside], odd[:-1]])
                inside = bool(odd[-1])
                heads = np.flatnonzero(begins)
                stop = int(heads[0]) if len(heads) else len(part)
                if stop:
                    open_lines += part.slice(0, stop).to_pylist()
                if not len(heads):
                    continue
                # all records but the last one end in this batch
                bounds = np.append(heads[:-1], heads[-1]) - heads[0]
                ended = part.slice(stop, int(heads[-1]) - stop)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), ended)
                records = pc.binary_join(lists, "\n").to_pylist()
                kinds, firsts = [WHOLE] * len(records), [False] * len(records)
                if open_lines:
                    records.insert(0, "\n".join(open_lines))
                    kinds.insert(0, kind)
                    firsts.insert(0, first)
                elif firsts:
                    firsts[0] = first
                if records:
                    yield piece(records, kinds, firsts)
                    first = False
                kind, open_lines = WHOLE, part.slice(int(heads[-1])).to_pylist()
        yield from closed()

    return run


def records(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """(record, first) of all files: the text of each record, and whether it opens its file.

    Written once in the shared folder, as both passes must see the same splits.  The number
    of splits, which is all that reaches the driver, is one the driver plans with anyway.
    """
    with _split_size(spark, split_bytes):
        lines = spark.read.option("lineSep", "\n").text(path).select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
        )
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        parities = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
        earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1
        inside_at = {
            (r["file"], r["start"]): r["inside"] for r in parities.select("file", "start", inside.alias("inside")).collect()
        }
        pieces = stored(lines.mapInArrow(_pieces(inside_at), _PIECE), "csv-pieces")
    fragments = pieces.filter(F.col("kind") != WHOLE)
    upto = Window.partitionBy("file").orderBy("start", "kind")
    begun = F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(upto)
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "record")))
    joined = (
        fragments.withColumn("begun", begun)
        .groupBy("file", "begun")
        .agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"), F.max("first").alias("first"))
    )
    whole = pieces.filter(F.col("kind") == WHOLE).select("record", "first")
    return whole.unionByName(joined.select("record", "first"))


def read(spark: SparkSession, path: str, options: dict[str, str], split_bytes: int | None = None) -> DataFrame:
    """All columns of CSV files with a header as text, one row per record.

    Quotes must be doubled inside a field and occur around fields only.  Files with
    different headers are an error.  Null and empty fields are as with the reader of
    whole files.
    """
    rows = records(spark, path, split_bytes)
    without_break = F.regexp_replace("record", "\r$", "")
    headers = rows.filter("first").select(without_break.alias("header")).distinct().limit(2).collect()
    if len(headers) != 1:
        raise ValueError(f"files under {path} have {'different headers' if headers else 'no header'}")
    names = next(csv.reader(io.StringIO(headers[0]["header"].removeprefix("﻿"))))
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    parsed = F.from_csv(without_break, schema, {**options, "header": "false"})
    return rows.filter(~F.col("first") & (F.col("record") != "")).select(parsed.alias("row")).select("row.*")
