"""Secret scan: fixed patterns, and a battery of randomness tests.

Long tokens are tested against the hypothesis that they are random strings of
their inferred encoding: chi-squared uniformity over the alphabet, runs about the
median, and lag-one serial correlation, combined by Fisher's method.  Per encoding
and length band, a Benjamini-Hochberg procedure over all tokens of the corpus
decides which of them are ordinary strings; those it cannot tell from random ones
are reported.  So among the tokens set aside, the share of random ones is bounded
by the rate, at every length.

A run that fits no single alphabet is split at the separators that do not fit, and
what a fixed pattern leaves of a run is tested too.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift.llm._store import stored

#: The patterns of the base kinds and the least length of a match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
MIN_LENGTH = 20
RATE = 0.05

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_DIGITS = "0123456789"
#: Encodings from the narrowest on; a token has the first that covers it.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"),
    ("hex_upper", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("alnum", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ("lower", _LOWER),
    ("upper", _UPPER),
    ("digits", _DIGITS),
)
_ONE_CLASS = range(6, 9)
_INDEX = [{c: i for i, c in enumerate(letters)} for _, letters in ENCODINGS]
#: p-values are counted in bins of this width of -ln p, rounded to the larger p.
BINS_PER_UNIT = 8
LAST_BIN = 800

_CLASSES = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))


def encoding_of(token: str) -> int | None:
    """Index into ENCODINGS; None for words, digit strings and mixed alphabets."""
    body = token.rstrip("=")
    if sum(bool(one.search(body)) for one in _CLASSES) < 2:
        return None
    letters = set(body)
    return next((i for i, index in enumerate(_INDEX) if letters <= index.keys()), None)


def alphabet_of(token: str) -> int | None:
    """As ``encoding_of``, but a token of one class of characters has an encoding of its own."""
    body = token.rstrip("=")
    letters = set(body)
    found = next((i for i in _ONE_CLASS if letters <= _INDEX[i].keys()), None)
    if found is None:
        found = next((i for i, index in enumerate(_INDEX) if letters <= index.keys()), None)
    return found if letters - set("+/_-") else None


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_tail(x: float, freedom: int) -> float:
    """Upper tail of chi-squared by the cube-root approximation."""
    z = ((x / freedom) ** (1 / 3) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom))
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity(x: np.ndarray, size: int) -> float:
    """Chi-squared over the alphabet, in as many cells as the length allows."""
    cells = int(max(2, min(size, len(x) // 5)))
    cell_of = np.arange(size) * cells // size
    expected = np.bincount(cell_of, minlength=cells) / size * len(x)
    seen = np.bincount(cell_of[x], minlength=cells)
    return _chi_tail(float(((seen - expected) ** 2 / expected).sum()), cells - 1)


def runs(x: np.ndarray, size: int) -> float:
    """Number of runs above and below the median of the alphabet."""
    high = x >= size // 2
    n = len(x)
    count = 1 + int((high[1:] != high[:-1]).sum())
    return _normal_tail((count - (n + 1) / 2) / math.sqrt((n - 1) / 4))


def correlation(x: np.ndarray, size: int) -> float:
    """Correlation of neighbours, with the mean and variance of the alphabet."""
    centred = x - (size - 1) / 2
    r = float((centred[1:] * centred[:-1]).sum()) / ((size * size - 1) / 12)
    return _normal_tail(r / math.sqrt(len(x) - 1))


def randomness(token: str, encoding: int) -> float:
    """p-value of the battery: small for strings that are not random."""
    index = _INDEX[encoding]
    x = np.array([index[c] for c in token.rstrip("=")])
    tests = (uniformity, runs, correlation)
    half = -sum(math.log(max(test(x, len(index)), 1e-300)) for test in tests)
    return math.exp(-half) * (1 + half + half * half / 2)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end), leftmost and not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    # A run of hex digits always matches as a whole, so its least length may go into the pattern.
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


_LONG_HEX = re.compile(HEX.pattern[:-1] + "{%d,}" % MIN_HEX)


_SPLITS = (re.compile("[^/+]+"), re.compile("[^_-]+"))


def _uncovered(start: int, end: int, known: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What ordered spans leave of a range."""
    left = []
    for a, b in known:
        if a > start:
            left.append((start, min(a, end)))
        start = max(start, b)
    return [*left, (start, end)] if start < end else left


def _tested(text: str, start: int, end: int) -> tuple[int, int, int, int] | None:
    """(start, end, stratum, bin) of a token that is long enough and fits one alphabet."""
    token = text[start:end]
    n = len(token.rstrip("="))
    encoding = alphabet_of(token) if n >= MIN_LENGTH else None
    if encoding is None:
        return None
    p = max(randomness(token, encoding), 1e-300)
    place = min(LAST_BIN, int(-math.log(min(p, 1.0)) * BINS_PER_UNIT))
    return start, end, encoding * 64 + n.bit_length(), place


def _split(text: str, start: int, end: int) -> list[tuple[int, int, int, int]]:
    """The parts of a run of mixed alphabets, cut at the one or the other kind of separators.

    Where such parts overlap, one stays: a part that may be random before others,
    the longer of those, and else the more random one.
    """
    parts = {(m.start(), m.end()) for one in _SPLITS for m in one.finditer(text, start, end)}
    found = [t for a, b in parts if (t := _tested(text, a, b))]
    likely = int(-math.log(RATE) * BINS_PER_UNIT)
    found.sort(key=lambda t: (t[3] > likely, t[0] - t[1] if t[3] <= likely else t[3], t[0]))
    kept: list[tuple[int, int, int, int]] = []
    for t in found:
        if all(t[1] <= k[0] or k[1] <= t[0] for k in kept):
            kept.append(t)
    return sorted(kept)


def candidates(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, stratum, bin) of tested tokens, outside of base spans."""
    merged: list[tuple[int, int]] = []
    for start, _, end in known:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    starts, ends = [a for a, _ in merged], [b for _, b in merged]
    found = []
    for m in TOKEN.finditer(text):
        near = merged[bisect_right(ends, m.start()) : bisect_left(starts, m.end())]
        for a, b in _uncovered(m.start(), m.end(), near):
            if near:
                a += len(text[a:b]) - len(text[a:b].lstrip("+/_-="))
                b -= len(text[a:b]) - len(text[a:b].rstrip("+/_-"))
            if b - a < MIN_LENGTH:
                continue
            body = set(text[a:b])
            if body & set("/+") and body & set("_-"):
                found += _split(text, a, b)
            elif t := _tested(text, a, b):
                found.append(t)
    return found


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64())]))
_TESTED = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("stratum", pa.int32()), ("bin", pa.int32())])
)
_KINDS_OF = (
    "base array<struct<start: long, rank: int, end: long>>, "
    "tested array<struct<start: long, end: long, stratum: int, bin: int>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, tested = [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            spans = base_spans(text)
            base.append([dict(zip(("start", "rank", "end"), s, strict=True)) for s in spans])
            names = ("start", "end", "stratum", "bin")
            tested.append([dict(zip(names, c, strict=True)) for c in candidates(text, spans)])
        columns = [batch.column(0), pa.array(base, _SPAN), pa.array(tested, _TESTED)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "base", "tested"])


def ordinary_bins(scanned: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per stratum, the first bin whose tokens are ordinary, by Benjamini-Hochberg.

    Counted over all tokens.  There are at most 64 strata per encoding, and one
    number of each comes to the driver.
    """
    tested = scanned.select(F.explode("tested").alias("t")).groupBy("t.stratum", "t.bin").count()
    below = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    every = Window.partitionBy("stratum")
    ranked = tested.select(
        "stratum", "bin", F.sum("count").over(below).alias("k"), F.sum("count").over(every).alias("m")
    )
    largest = F.exp(-F.col("bin") / F.lit(float(BINS_PER_UNIT)))
    passed = ranked.where(largest <= F.lit(rate) * F.col("k") / F.col("m"))
    return {r["stratum"]: r["first"] for r in passed.groupBy("stratum").agg(F.min("bin").alias("first")).collect()}


def scan_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", rate: float = RATE) -> DataFrame:
    """Key and ``spans`` (start, rank, end) of every row, in code points.

    One pass over the text; its small result is written and read for the two
    steps after.  A null or empty text has no spans; repeated rows and null keys
    stay as they are; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    scanned = stored(rows.mapInArrow(_scan, f"key {kind}, {_KINDS_OF}"), "secrets")
    first = ordinary_bins(scanned, rate)
    limits = F.create_map(*[F.lit(x) for pair in first.items() for x in pair]) if first else None
    never = F.lit(LAST_BIN + 1)

    def random(t):
        limit = F.coalesce(limits[t["stratum"]], never) if limits is not None else never
        return t["bin"] < limit

    added = F.transform(
        F.filter("tested", random),
        lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("rank"), t["end"].alias("end")),
    )
    spans = F.array_sort(F.concat("base", added))
    return scanned.select(F.col("key").alias(key), "base", spans.alias("spans"))


def spans_text(spans: str):
    """``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )
