"""Quality rules with compression bands.

Zstandard compresses every whole text and every fixed chunk of it.  A text that
compresses better than the lower limit of its length band repeats itself; one
that compresses worse than the upper limit is noise.  Limits depend on the
length, since short texts hardly compress.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from jobsift.llm._words import (
    WHITE,
    RangeHash,
    Texts,
    covered,
    repeated,
    salted,
    slices,
    totals,
    windows,
    words_of,
)

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Band:
    """Limits of compressed by raw size for texts of at least ``size`` bytes."""

    size: int
    low: float
    high: float


#: Of whole texts.  A later band holds from its size on.
DOCUMENT_BANDS = (
    Band(0, 0.0, 2.0),
    Band(200, 0.15, 0.95),
    Band(500, 0.20, 0.90),
    Band(1_000, 0.20, 0.85),
    Band(4_000, 0.15, 0.80),
    Band(20_000, 0.12, 0.75),
)
CHUNK_BYTES = 4096
#: Of chunks; shorter rests of a text are left to the bands of whole texts.
CHUNK_BAND = Band(CHUNK_BYTES, 0.06, 0.80)
#: Largest share of the chunks of a text that may lie outside their band.
CHUNK_SHARE = 0.5

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, n_chunks long, n_low_chunks long, n_high_chunks long, "
    "base_failed boolean, band_failed boolean, kept boolean"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def _band_of(sizes: np.ndarray, bands: tuple[Band, ...]) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted([b.size for b in bands], sizes, "right") - 1
    return np.array([b.low for b in bands])[at], np.array([b.high for b in bands])[at]


def _line_repeats(texts: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    data, bounds = texts.bytes, texts.bounds
    breaks = np.flatnonzero(data == 0x0A)
    start = np.union1d(breaks + 1, bounds[:-1])
    start = start[start < len(data)]
    if not len(start):
        return np.zeros(len(texts), np.int64)
    end = np.append(start[1:], len(data))
    end = end - (data[end - 1] == 0x0A)
    text = np.searchsorted(bounds, start, "right") - 1
    solid = totals(~WHITE[data], np.append(start, len(data))) > 0
    start, end, text = start[solid], end[solid], text[solid]
    lines = salted(RangeHash(data).of(start, end), text)
    distinct = text[np.unique(lines, return_index=True)[1]]
    return np.bincount(text, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def _compression(texts: Texts, chunk: int, band: Band) -> tuple[np.ndarray, ...]:
    press = zstandard.ZstdCompressor(level=3)
    n = len(texts)
    ratio, chunks, low, high = np.ones(n), *(np.zeros(n, np.int64) for _ in range(3))
    for i in range(n):
        raw = texts.raw(i)
        if not len(raw):
            continue
        ratio[i] = len(press.compress(raw)) / len(raw)
        for at in range(0, len(raw) - chunk + 1, chunk):
            share = len(press.compress(raw[at : at + chunk])) / chunk
            chunks[i] += 1
            low[i] += share < band.low
            high[i] += share > band.high
    return ratio, chunks, low, high


def measured(
    texts: Texts,
    bands: tuple[Band, ...] = DOCUMENT_BANDS,
    chunk: int = CHUNK_BYTES,
    chunk_band: Band = CHUNK_BAND,
    chunk_share: float = CHUNK_SHARE,
) -> list[np.ndarray]:
    """The columns of ``SCHEMA`` for the texts of a slice."""
    words = words_of(texts)
    n_words = np.diff(words.first)
    points = (texts.bytes & 0xC0) != 0x80
    sums = np.zeros(len(points) + 1, np.int64)
    np.cumsum(points, out=sums[1:])
    lengths = np.append(0, np.cumsum(sums[words.end] - sums[words.start]))
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    start, text = windows(words.first, WINDOW)
    grams = RangeHash(words.hash).grams(WINDOW)
    twice = repeated(salted(grams[start], text)) if len(start) else np.zeros(0, bool)
    inside = covered(start[twice], WINDOW, len(words.hash))
    n_repeat = totals(inside, words.first)
    ratio, chunks, low, high = _compression(texts, chunk, chunk_band)
    base_failed = (n_words < 20) | (100 * n_repeat > 30 * n_words)
    least, most = _band_of(np.diff(texts.bounds), bands)
    band_failed = (ratio < least) | (ratio > most) | (low + high > chunk_share * chunks)
    return [
        n_words,
        np.diff(lengths[words.first]),
        totals(table[texts.bytes], texts.bounds),
        _line_repeats(texts),
        n_repeat,
        ratio,
        chunks,
        low,
        high,
        base_failed,
        band_failed,
        ~base_failed & ~band_failed,
    ]


def _columns(text: pa.Array, **limits) -> list[np.ndarray]:
    found = [measured(part, **limits) for part in slices(text)]
    if not found:
        return [np.zeros(0, bool if name in _NAMES[-3:] else None) for name in _NAMES]
    return [np.concatenate(parts) for parts in zip(*found, strict=True)]


def quality(docs: DataFrame, text: str = "text", key: str = "doc_id", **limits) -> DataFrame:
    """Key and quality measures of every row; a projection, nothing moves.

    A null or empty text has no words and fails the base rules; its ratio is 1.
    Repeated rows are judged one by one, null keys are kept, other columns are
    not read.  A text is compressed as a whole, so a task's memory is bound by
    its longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _columns(batch.column(1), **limits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)], ["key", *_NAMES]
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


def kept_documents(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows that pass, with all their columns; repeated rows stay repeated."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_columns(batch.column(place), **limits)[-1].astype(bool)))

    return docs.mapInArrow(run, docs.schema)
