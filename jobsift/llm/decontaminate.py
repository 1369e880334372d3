"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders, so a question with other
parameters has the same template.  Windows of template tokens of the benchmark
are joined by hash with those of the corpus; aligned windows count when the slots
agree, which means that a value of the item always became the same value.

What is a name can only be guessed from capitals, so a text is read in four forms
and an item is found in any of them: names inside a sentence as placeholders; names
as folded words, for copies in another letter case; every capitalised word as a
possible name, for names that open a sentence; and all tokens as they are, with
their numbers, for items and windows with few literals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift.llm._words import RangeHash, Texts, buffer_of, mixed, slices, totals
from jobsift.llm._store import free_name, stored

WINDOW = 8
MIN_LITERALS = 4
COVERAGE = 0.5
#: Consecutive windows of plain tokens that count without coverage: 13 tokens word for word.
RUN_WINDOWS = 6
#: Window hashes of the benchmark that go to the executors at once; more go in several passes.
BLOCK_WINDOWS = 1_000_000
#: Rows of benchmark windows that are broadcast in the join that follows; more are shuffled.
BROADCAST_WINDOWS = 100_000

FORMS = INNER, FOLDED, OPEN, PLAIN = range(4)
LITERAL, NUMBER, NAME, UNIT = range(4)
KINDS = ("literal", "number", "name", "unit")
NUMBER_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm km kg mg lb lbs oz ml mph kph kmh hz khz mhz ghz kb mb gb tb kw mw meter meters metre metres kilometer "
    "kilometers kilometre kilometres centimeter centimeters mile miles foot feet inch inches yard yards gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons liter liters litre litres gallon gallons second seconds "
    "minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros "
    "percent degree degrees celsius fahrenheit volt volts watt watts newton newtons joule joules"
).split()

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
#: Bytes after which a capital letter does not make a name.
_SENTENCE = np.zeros(256, bool)
_SENTENCE[list(b'.!?:;\n"|([*#-')] = True


#: Scripts written without spaces, by the first two bytes of a character.
_UNSPACED = np.zeros(1 << 16, bool)
for _low, _high in ((0xE0B8, 0xE0BB), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE380, 0xE9BF), (0xEFA4, 0xEFAB), (0xEFBC, 0xEFBE), (0xF0A0, 0xF0B3)):
    _UNSPACED[_low : _high + 1] = True


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last bytes of the characters of such scripts, and the bytes of their punctuation."""
    at = np.flatnonzero(data >= 0xE0)
    size = np.where(data[at] >= 0xF0, 4, 3)
    at, size = at[at + size <= len(data)], size[at + size <= len(data)]
    wide = data.astype(np.int64)
    among = _UNSPACED[wide[at] << 8 | wide[at + 1]]
    at, size = at[among], size[among]
    point = (wide[at] & 15) << 12 | (wide[at + 1] & 63) << 6 | wide[at + 2] & 63
    marks = (point >= 0x3000) & (point <= 0x303F) & ~((point >= 0x3005) & (point <= 0x3007))
    for low, high in ((0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)):
        marks |= (point >= low) & (point <= high)
    marks |= point == 0x30FB
    marks &= size == 3
    punctuation = (at[marks][:, None] + np.arange(3)).ravel()
    return at[~marks], at[~marks] + size[~marks] - 1, punctuation


def _word_hashes(words: list[str]) -> np.ndarray:
    data, bounds = buffer_of(pa.array(words))
    return np.sort(RangeHash(data).of(bounds[:-1], bounds[1:]))


_NUMBERS, _UNITS = _word_hashes(NUMBER_WORDS), _word_hashes(UNIT_WORDS)


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


@dataclass
class Template:
    """Template tokens of a slice; those of text ``i`` are ``first[i]:first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    kind: np.ndarray
    first: np.ndarray


def template(texts: Texts, form: int = INNER) -> Template:
    """Canonical tokens: runs of letters and digits, letter case folded.

    Tokens with a digit and number words are numbers, unit words are units, words
    with one capital first letter inside a sentence are names.  Numbers and names
    side by side make one slot.  A character of a script without spaces is a token.
    No word is a name in ``FOLDED``, every word with a capital first letter is one
    in ``OPEN``, and all tokens are literals in ``PLAIN``.
    """
    data, bounds = texts.bytes, texts.bounds
    n = len(data)
    solid = _TOKEN[data]
    heads, tails, punctuation = _unspaced(data)
    solid[punctuation] = False
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    begins[heads], ends[tails] = True, True
    before, behind = heads[heads > 0] - 1, tails[tails < n - 1] + 1
    ends[before], begins[behind] = solid[before], solid[behind]
    inner = bounds[(bounds > 0) & (bounds < n)]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, bounds)

    upper = (data >= 0x41) & (data <= 0x5A)
    # Latin letters of two bytes: capitals C3 80 to C3 9E, but for the multiplication sign.
    latin = np.zeros(n, bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded = np.where(upper | latin, data | 0x20, data)
    hashes = RangeHash(folded).of(start, end)

    capital = upper.copy()
    capital[:-1] |= latin[1:]
    numbers = np.zeros(n + 1, np.int64)
    np.cumsum(_DIGIT[data], out=numbers[1:])
    capitals = np.zeros(n + 1, np.int64)
    np.cumsum(upper | latin, out=capitals[1:])
    breaks = np.zeros(n + 1, np.int64)
    np.cumsum(_SENTENCE[data], out=breaks[1:])
    kind = np.zeros(len(start), np.int8)
    if len(start) and form != PLAIN:
        gap = np.append(bounds[0], end[:-1])
        opens = breaks[start] > breaks[np.minimum(gap, start)]
        heads = first[:-1][first[:-1] < first[1:]]
        opens[heads] = True
        name = capital[start] & (end - start > 1)
        if form == INNER:
            name &= ~opens & (capitals[end] - capitals[start] == 1)
        if form != FOLDED:
            kind[name] = NAME
        kind[_among(hashes, _UNITS)] = UNIT
        kind[(numbers[end] > numbers[start]) | _among(hashes, _NUMBERS)] = NUMBER
        follows = np.zeros(len(start), bool)
        follows[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) | (kind[1:] == NAME)) & (start[1:] - end[:-1] <= 1)
        follows[heads] = False
        keep = np.flatnonzero(~follows)
        last = np.append(keep[1:], len(start)) - 1
        first = np.searchsorted(keep, first)
        start, end, hashes, kind = start[keep], end[last], hashes[keep], kind[keep]
        hashes = np.where(kind > 0, mixed(kind.astype(np.uint64) + np.uint64(0xA5A5)), hashes)
    return Template(start, end, hashes, kind, first)


def _windows(t: Template, size: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first token and text of the windows with enough literal tokens."""
    counts = np.maximum(np.diff(t.first) - (size - 1), 0)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + t.first[:-1][text]
    if not len(at):
        return np.zeros(0, np.uint64), at, text
    literal = np.zeros(len(t.kind) + 1, np.int64)
    np.cumsum(t.kind == LITERAL, out=literal[1:])
    enough = literal[at + size] - literal[at] >= min(least, size)
    at, text = at[enough], text[enough]
    return RangeHash(t.hash).grams(size)[at], at, text


def _slots(texts: Texts, t: Template, at: int, size: int) -> list[str]:
    found = []
    for k in range(at, at + size):
        if t.kind[k]:
            raw = texts.bytes[t.start[k] : t.end[k]].tobytes().decode("utf-8", "replace")
            found.append(raw.lower())
    return found


_HIT = "form int, hash long, size int, place long, slots array<string>"


def benchmark_windows(benchmark: DataFrame, text: str, key: str, size: int, least: int) -> DataFrame:
    """(item, form, hash, size, place, slots) of all windows of the items.

    An item shorter than a window is one window of its own length; without enough literal tokens it has none but in ``PLAIN``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for texts in slices(batch.column(1)):
                items = batch.column(0)[texts.rows].to_pylist()
                for form in FORMS:
                    t = template(texts, form)
                    enough = 0 if form == PLAIN else least
                    lengths = np.diff(t.first)
                    for width in {int(min(size, n)) for n in lengths if n}:
                        hashes, at, text_of = _windows(t, width, enough)
                        right = np.minimum(size, lengths[text_of]) == width
                        literals = totals(t.kind == LITERAL, t.first)[text_of] >= enough
                        for i in np.flatnonzero(right & literals):
                            rows.append(
                                {
                                    "item": items[text_of[i]],
                                    "form": form,
                                    "hash": int(hashes[i].astype(np.int64)),
                                    "size": width,
                                    "place": int(at[i] - t.first[text_of[i]]),
                                    "slots": _slots(texts, t, int(at[i]), width),
                                }
                            )
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _schema(batch.schema.field(0).type, "item"))

    kind = benchmark.schema[key].dataType.simpleString()
    rows = benchmark.select(benchmark[key].alias("item"), benchmark[text].cast("string").alias("text"))
    return rows.mapInArrow(run, f"item {kind}, {_HIT}").dropDuplicates(["item", "form", "size", "place"])


def _schema(kind: pa.DataType, name: str, *more: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema(
        [
            (name, kind),
            *more,
            ("form", pa.int32()),
            ("hash", pa.int64()),
            ("size", pa.int32()),
            ("place", pa.int64()),
            ("slots", pa.list_(pa.string())),
        ]
    )


def corpus_hits(docs: DataFrame, text: str, key: str, wanted: dict[tuple[int, int], np.ndarray], least: int) -> DataFrame:
    """(key, mark, form, hash, size, place, slots) of the corpus windows whose hash is wanted."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            schema = _schema(batch.schema.field(0).type, "key", ("mark", pa.int64()))
            for texts in slices(batch.column(2)):
                templates = {form: template(texts, form) for form in {form for form, _ in sent.value}}
                for (form, width), ordered in sent.value.items():
                    t = templates[form]
                    hashes, at, text_of = _windows(t, width, 0 if form == PLAIN else least)
                    hit = np.flatnonzero(_among(hashes, ordered))
                    for i in hit:
                        row = texts.rows.start + int(text_of[i])
                        rows.append(
                            {
                                "key": batch.column(0)[row].as_py(),
                                "mark": batch.column(1)[row].as_py(),
                                "form": form,
                                "hash": int(hashes[i].astype(np.int64)),
                                "size": width,
                                "place": int(at[i] - t.first[text_of[i]]),
                                "slots": _slots(texts, t, int(at[i]), width),
                            }
                        )
                        if len(rows) >= 20_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    kind = docs.schema[key].dataType.simpleString()
    value = docs[text].cast("string")
    rows = docs.select(docs[key].alias("key"), F.xxhash64(value).alias("mark"), value.alias("text"))
    return rows.mapInArrow(run, f"key {kind}, mark long, {_HIT}")


def _blocks(windows: DataFrame, block: int) -> Iterator[dict[tuple[int, int], np.ndarray]]:
    """The distinct window hashes by form and size, at most ``block`` at a time."""
    distinct = windows.select("form", "size", "hash").distinct()
    passes = max(1, -(-distinct.count() // block))
    part = F.pmod(F.xxhash64("hash"), F.lit(passes))
    for i in range(passes):
        rows = distinct.where(part == i).collect()  # about ``block`` rows
        found: dict[tuple[int, int], list[int]] = {}
        for r in rows:
            found.setdefault((r["form"], r["size"]), []).append(r["hash"])
        yield {k: np.sort(np.array(found[k], np.int64).astype(np.uint64)) for k in sorted(found)}


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    window: int = WINDOW,
    least: int = MIN_LITERALS,
    coverage: float = COVERAGE,
    run: int = RUN_WINDOWS,
) -> DataFrame:
    """(key, mark, item, n_matched, n_windows, n_alignments): documents that hold an item.

    A pair counts when in one form at least ``coverage`` of the windows of the item
    occur in alignments with consistent slots, or when ``run`` windows of plain
    tokens occur one after another.  The figures are those of the first such form.
    ``mark`` is the xxhash64 of the text, which
    with the key tells rows apart whose keys are null or repeated; equal rows give
    one.  Null and empty texts match nothing; items without enough literal tokens
    match word for word.  The benchmark is a stated query set: its window hashes go to all
    rows, in passes of bounded size.
    """
    windows = stored(benchmark_windows(benchmark, item_text, item_key, window, least), "benchmark-windows")
    hits = None
    for wanted in _blocks(windows, BLOCK_WINDOWS):
        found = corpus_hits(docs, text, key, wanted, least)
        hits = found if hits is None else hits.unionByName(found)
    hits = stored(hits, "benchmark-hits")
    named = windows.select("item", "form", "hash", "size", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    if windows.count() <= BROADCAST_WINDOWS:
        named = F.broadcast(named)
    aligned = hits.join(named, ["form", "hash", "size"]).where(F.size("slots") == F.size("item_slots"))
    aligned = aligned.withColumn("shift", F.col("place") - F.col("item_place"))
    same = ["key", "mark", "item", "form", "shift"]
    pairs = aligned.select(*same, F.explode(F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))).alias("s"))
    values = pairs.groupBy(*same, F.col("s.a").alias("a")).agg(F.min("s.b").alias("low"), F.max("s.b").alias("high"))
    broken = values.where("low <> high").select(*same).distinct().withColumn("broken", F.lit(True))
    conditions = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in same]
    condition = conditions[0]
    for one in conditions[1:]:
        condition &= one
    agreeing = aligned.alias("l").join(broken.alias("r"), condition, "left_anti")
    # Consecutive places of an alignment have the same distance to their rank.
    pair = ["key", "mark", "item", "form"]
    plain = agreeing.where(F.col("form") == PLAIN).select(*same, "item_place").distinct()
    rank = F.row_number().over(Window.partitionBy(*same).orderBy("item_place"))
    stretches = plain.withColumn("stretch", F.col("item_place") - rank).groupBy(*same, "stretch").agg(F.count(F.lit(1)).alias("run"))
    longest = stretches.groupBy(*pair).agg(F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("shift"), F.max("run").alias("run"))
    places = agreeing.select(*pair, F.col("item_place").alias("place"), "shift", F.lit(0).cast("long").alias("run"))
    matched = places.unionByName(longest).groupBy(*pair).agg(
        F.countDistinct("place").alias("n_matched"), F.countDistinct("shift").alias("n_alignments"), F.max("run").alias("run")
    )
    sizes = windows.groupBy("item", "form").agg(F.count(F.lit(1)).alias("n_windows")).toDF("i", "f", "n_windows")
    judged = matched.join(sizes, F.col("item").eqNullSafe(F.col("i")) & (F.col("form") == F.col("f")))
    found = judged.where((F.col("n_matched") >= F.lit(coverage) * F.col("n_windows")) | (F.col("run") >= run))
    best = found.groupBy("key", "mark", "item").agg(F.min(F.struct("form", "n_matched", "n_windows", "n_alignments")).alias("b"))
    return best.select(F.col("key").alias(key), "mark", "item", "b.n_matched", "b.n_windows", "b.n_alignments")


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows that hold no benchmark item, with all their columns."""
    found = contaminated(docs, benchmark, text, key, **options).select(F.col(key).alias("k"), F.col("mark").alias("m"))
    named, told = free_name(docs, "found_key"), free_name(docs, "found_mark")
    found = found.distinct().toDF(named, told)
    same = docs[key].eqNullSafe(found[named]) & (F.xxhash64(docs[text].cast("string")) == found[told])
    return docs.join(found, same, "left_anti")
