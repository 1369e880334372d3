"""Removal of repeated word passages by compressed full-text indexes.

Regions that may repeat are dealt to shards by their anchors, so that all copies
of a window lie in one shard, once for each place where it starts.  Every shard
builds an FM-index of its regions: the Burrows-Wheeler transform in a wavelet
matrix of bit vectors with rank blocks.  Backward search of all regions at once
gives the matching statistics, and the windows that occur elsewhere as intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm import _anchors
from jobsift.llm._words import Texts, slices, words_of
from jobsift.llm._store import stored

WINDOW = 35
GRAM = 12
#: Words of regions that the index of one shard holds.
SHARD_WORDS = 400_000


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, compared over ``depth`` symbols at least."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    order, done = np.argsort(rank, kind="stable"), 1
    while done < depth:
        behind = np.zeros(n, np.int64)
        behind[: n - done] = rank[done:] + 1
        pair = rank * (n + 2) + behind
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        steps = np.append(0, np.cumsum(ordered[1:] != ordered[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = steps
        done *= 2
        if n == 0 or steps[-1] == n - 1:
            break
    return order


class BitVector:
    """Packed bits with a rank sum per 64."""

    def __init__(self, bits: np.ndarray) -> None:
        self.length = len(bits)
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))[:-1].astype(np.int32)
        self.ones = int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each position."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low).astype(np.int64)


class WaveletMatrix:
    """Ranks of symbols over a sequence, in one bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = ((symbols >> bit) & 1).astype(np.uint8)
            self.levels.append((bit, BitVector(ones)))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``lo`` and before ``hi``; ``base`` is where it starts in the last level."""
        lo, hi = lo.copy(), hi.copy()
        for bit, vector in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            zeros = vector.length - vector.ones
            for side in (lo, hi):
                rank = vector.rank(side)
                np.copyto(side, np.where(one, zeros + rank, side - rank))
        return lo - base, hi - base

    def starts(self, symbols: np.ndarray) -> np.ndarray:
        at = np.zeros(len(symbols), np.int64)
        for bit, vector in self.levels:
            rank = vector.rank(at)
            one = ((symbols >> bit) & 1).astype(bool)
            at = np.where(one, vector.length - vector.ones + rank, at - rank)
        return at


class FMIndex:
    """Backward search over a sequence of symbols 0 .. size - 1."""

    def __init__(self, symbols: np.ndarray, depth: int) -> None:
        n = len(symbols)
        # The end of the sequence is a symbol of its own, below all others.
        text = np.append(symbols + 1, 0)
        order = suffix_order(text, depth)
        size = int(text.max()) + 1
        self.matrix = WaveletMatrix(text[order - 1], max(1, (size - 1).bit_length()))
        self.smaller = np.append(0, np.cumsum(np.bincount(text, minlength=size)))
        self.base = self.matrix.starts(np.arange(size))
        self.length = n + 1

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after one more symbol to the left."""
        coded = symbol + 1
        a, b = self.matrix.rank(coded, lo, hi, self.base[coded])
        return self.smaller[coded] + a, self.smaller[coded] + b


def repeated_windows(symbols: np.ndarray, first: np.ndarray, width: int, depth: int) -> np.ndarray:
    """Marks of the positions where a window of ``width`` starts that occurs twice or more.

    ``symbols`` are the regions one after another, region ``i`` from ``first[i]``
    to ``first[i + 1]``, each ended by a separator of its own.  All regions are
    searched backwards at once while their match still occurs twice.  Where one
    fails, windows over the failing match are unique, and the search goes on from
    the rightmost end that is still open.
    """
    index = FMIndex(symbols, depth)
    marks = np.zeros(len(symbols), bool)
    start = first[:-1].copy()
    end = first[1:] - 1  # without the separator
    at, stop = end.copy(), end.copy()
    lo, hi = np.zeros(len(start), np.int64), np.full(len(start), index.length)
    live = np.flatnonzero(end - start >= width)
    while len(live):
        a, b = index.extend(symbols[at[live] - 1], lo[live], hi[live])
        good = b - a >= 2
        going = live[good]
        lo[going], hi[going] = a[good], b[good]
        at[going] -= 1
        marks[at[going][stop[going] - at[going] >= width]] = True
        # A match longer than the window says no less about the windows in it.
        failed = live[~good]
        stop[failed] = np.minimum(stop[failed] - 1, at[failed] - 1 + width)
        at[failed] = stop[failed]
        lo[failed], hi[failed] = 0, index.length
        live = live[(at[live] > start[live]) & (stop[live] - start[live] >= width)]
    return marks


def _word_units(texts: Texts):
    words = words_of(texts)
    return words.hash, words.first


def _word_ranges(texts: Texts):
    words = words_of(texts)
    return words.hash, words.first, words.start, words.end


def _shard(table: pa.Table, width: int, buckets: int) -> pa.Table:
    regions = _anchors.Contexts(table)
    rows, starts, ends = regions.done
    if len(regions.keys):
        words = words_of(Texts(slice(0, len(regions.keys)), regions.bytes, regions.bounds))
        counts = np.diff(words.first)
        distinct, ids = np.unique(words.hash, return_inverse=True)
        first = np.append(0, np.cumsum(counts + 1))
        symbols = np.zeros(first[-1], np.int64)
        region = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(ids)) - words.first[:-1][region] + first[region]
        # One separator symbol is enough: a window never holds it.
        symbols[place] = ids + 1
        marks = repeated_windows(symbols, first, width, int(counts.max()) + 1)
        hit = np.flatnonzero(marks)
        owner = np.searchsorted(first, hit, "right") - 1
        found = regions.starts[owner] + hit - first[owner]
        rows = np.concatenate([rows, regions.rows[owner]])
        starts, ends = np.concatenate([starts, found]), np.concatenate([ends, found + width])
    return _anchors.spans_table(rows, starts, ends, buckets)


def _anchor_hits(table: pa.Table, buckets: int, limit: int) -> pa.Table:
    keys, flags, rows, spots, done_rows, done_spots = _anchors.unpacked(table)
    found = _anchors.repeated_entries(keys) & (flags == 0)
    hot = _anchors.hot_keys(keys, flags, limit)
    return _anchors.hits_table(
        np.concatenate([rows[found], done_rows]), np.concatenate([spots[found], done_spots]), buckets, hot
    )


def repeated_passages(rows: DataFrame, width: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(row, spans): packed word spans of the (row, text) rows that lie in repeated windows."""
    spark = rows.sparkSession
    w = width - gram + 1
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About one anchor per 70 bytes of text.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(buckets, -(-n_bytes // 70 // _anchors.SHARD_ENTRIES))
    limit = _anchors.hot_limit(n_bytes // 70)
    packed = _anchors.entries(rows, _word_units, gram, w, shards)

    def hits_of(table: pa.Table) -> pa.Table:
        return _anchor_hits(table, buckets, limit)

    hits = stored(packed.groupBy("shard").applyInArrow(hits_of, _anchors.HIT_SCHEMA), "anchor-hits")
    n_hits = (hits.agg(F.sum(F.octet_length("spots"))).first()[0] or 0) // _anchors.SPOT.itemsize
    shards = max(buckets, -(-n_hits * (width + w // 2) // SHARD_WORDS))
    placed = _anchors.with_hits(rows.withColumn("rank", F.lit(0).cast("long")), hits)
    regions = _anchors.contexts(placed, _word_ranges, gram, width, shards, False, _anchors.hot_of(hits))

    def verdict(table: pa.Table) -> pa.Table:
        return _shard(table, width, buckets)

    return stored(regions.groupBy("shard").applyInArrow(verdict, _anchors.SPAN_SCHEMA), "word-spans")


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(key, n_words, n_removed, kept, spans) of every row; ``kept`` joins the words left by one space.

    A window of ``width`` words is removed wherever its words also start at
    another place of the corpus, the same row and equal rows included.  Null and
    empty texts have no words.  ``spans`` lists (start, end) word ranges removed.
    """
    value = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(_anchors.row_id(docs, key, text).alias("row"), docs[key].alias("key"), value.alias("text"))
    spans = repeated_passages(rows.select("row", "text"), width, gram)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(2)):
                words = words_of(texts)
                n_words, n_removed, kept, lists = np.diff(words.first), [], [], []
                for i, value in enumerate(batch.column(3)[texts.rows]):
                    base, n = words.first[i], int(n_words[i])
                    found = _anchors.spans_of(value.as_py())
                    keep = np.ones(n, bool)
                    for a, b in found.tolist():
                        keep[a:b] = False
                    chosen = np.flatnonzero(keep) + base
                    raw = texts.bytes.tobytes() if i == 0 else raw
                    pieces = [raw[a:b] for a, b in zip(words.start[chosen].tolist(), words.end[chosen].tolist(), strict=True)]
                    kept.append(b" ".join(pieces).decode())
                    n_removed.append(n - int(keep.sum()))
                    lists.append([{"start": a, "end": b} for a, b in found.tolist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[texts.rows], pa.array(n_words), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(lists, _SPANS)],
                    ["key", "n_words", "n_removed", "kept", "spans"],
                )

    joined = _anchors.with_spans(rows, spans).select("row", "key", "text", "spans")
    schema = f"key {kind}, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long>>"
    return joined.mapInArrow(run, schema).withColumnRenamed("key", key)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
