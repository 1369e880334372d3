"""Repeated passages found through sampled positions.

Of every window of k + w - 1 units (bytes or words), the k-gram with the least
hash is its anchor, so equal windows have equal anchors at equal places, and only
about 2 in w + 1 positions are anchors.  An anchor owns the windows that chose it.
A window can only be repeated if its anchor is, so first the anchors that occur
twice are found, then only the windows these own are compared.

Numbers travel as packed arrays, one row per shard and group of texts, and what is
found as one row per shard and bucket of rows.  What already repeats inside a group of
texts is decided there, and one of it is sent on.  Where a passage that many documents
share meets their different surroundings, an anchor owns regions that differ in each: the
windows of an anchor with very many regions are dealt one by one, by their own hash,
so no anchor fills one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.llm._words import RangeHash, Texts, mixed, slices

#: An anchor in its text: unit, and how far before it its first and last window start.
SPOT = np.dtype([("pos", "<u4"), ("lo", "u1"), ("hi", "u1")])
#: Texts are packed in groups of this many bytes.
GROUP_BYTES = 12 << 20
#: Owned regions are packed in groups of this many bytes.
REGION_BYTES = 10 << 20
#: Packed entries per shard that a task holds.
SHARD_ENTRIES = 1 << 18
#: Regions from which an anchor's windows are dealt one by one, and the most anchors that may be so.
HOT_REGIONS = 2048
HOT_ANCHORS = 1 << 20
#: Bucket of the rows that hold hot anchors.
HOT = -1

Units = Callable[[Texts], tuple[np.ndarray, np.ndarray]]


def planes(values: np.ndarray) -> bytes:
    """The bytes of the values, most alike first, which the shuffle's compression likes."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def unplaned(data: bytes, kind: np.dtype | str) -> np.ndarray:
    kind = np.dtype(kind)
    flat = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(flat.T).reshape(-1).view(kind)


def anchors_of(units: np.ndarray, first: np.ndarray, k: int, w: int) -> tuple[np.ndarray, ...]:
    """Key, text, unit, first and last owned window of all anchors, in order."""
    size, n = k + w - 1, len(units)
    counts = np.maximum(np.diff(first) - (size - 1), 0)
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    grams = RangeHash(units).grams(k)
    least, where, span = grams, np.arange(len(grams), dtype=np.int32), 1

    def joined(step: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[step : step + count] < least[:count]
        return (
            np.where(right, least[step : step + count], least[:count]),
            np.where(right, where[step : step + count], where[:count]),
        )

    while span * 2 <= w:
        least, where = joined(span, len(least) - span)
        span *= 2
    if span < w:
        least, where = joined(w - span, len(least) - (w - span))
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + first[:-1][text]
    at = where[start].astype(np.int64)
    new = np.ones(total, bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], total) - 1
    return grams[at[head]], text[head], at[head], start[head], start[tail]


def row_id(docs: DataFrame, key: str, text: str) -> Column:
    """Identity of a row for joins; equal rows share it and their verdicts."""
    return F.xxhash64(docs[key], docs[text].cast("string"), F.lit(7))


ENTRY_SCHEMA = "shard int, keys binary, flags binary, text binary, spots binary, rows binary, done_text binary, done_spots binary"
ENTRY_NAMES = [part.split()[0] for part in ENTRY_SCHEMA.split(", ")]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards of keys; mixed once more, since keys are least hashes and so not even."""
    return (mixed(keys) >> np.uint64(32)).astype(np.int64) * shards >> 32


def _packed(shards: int, rows: np.ndarray, keys: np.ndarray, text: np.ndarray, spots: np.ndarray) -> pa.RecordBatch:
    """Rows of ENTRY_SCHEMA for the anchors of a group of texts."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    twice = ~head
    twice[:-1] |= ~head[1:]
    sent, done = order[head], order[twice]
    # How many more a group has; from one on they are decided.
    copies = np.diff(np.append(np.flatnonzero(head), len(keys)))
    flags = np.minimum(copies - 1, 255).astype(np.uint8)
    place = shard_of(keys[sent], shards)
    even = np.argsort(place, kind="stable")
    sent, flags, cuts = sent[even], flags[even], np.searchsorted(place[even], np.arange(shards + 1))
    where = text[done] % shards
    by_shard = np.argsort(where, kind="stable")
    done, done_cuts = done[by_shard], np.searchsorted(where[by_shard], np.arange(shards + 1))
    columns: list[list] = [[] for _ in ENTRY_NAMES]
    for s in range(shards):
        a, b, c, d = cuts[s], cuts[s + 1], done_cuts[s], done_cuts[s + 1]
        if a == b and c == d:
            continue
        mine, ready = sent[a:b], done[c:d]
        used, local = np.unique(np.concatenate([text[mine], text[ready]]), return_inverse=True)
        local = local.astype("<u4")
        values = (
            s,
            planes(keys[mine]),
            flags[a:b].tobytes(),
            planes(local[: b - a]),
            planes(spots[mine]),
            planes(rows[used]),
            planes(local[b - a :]),
            planes(spots[ready]),
        )
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    kinds = [pa.int32(), *[pa.binary()] * 7]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ENTRY_NAMES)


def entries(rows: DataFrame, units: Units, k: int, w: int, shards: int) -> DataFrame:
    """Packed anchors of (row, text) rows by shard of their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for texts in slices(batch.column(1)):
                found, first = units(texts)
                keys, text, at, lo, hi = anchors_of(found, first, k, w)
                spots = np.empty(len(at), SPOT)
                spots["pos"], spots["lo"], spots["hi"] = at - first[text], at - lo, at - hi
                used, local = np.unique(text, return_inverse=True)
                held.append((ids[texts.rows][used], keys, local, spots))
                size += len(texts.bytes)
                if size >= GROUP_BYTES:
                    yield _group(held, shards)
                    held, size = [], 0
        if held:
            yield _group(held, shards)

    return rows.select("row", "text").mapInArrow(run, ENTRY_SCHEMA)


def _group(held: list[tuple], shards: int) -> pa.RecordBatch:
    base = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
    return _packed(
        shards,
        np.concatenate([h[0] for h in held]),
        np.concatenate([h[1] for h in held]),
        np.concatenate([h[2] + b for h, b in zip(held, base, strict=True)]),
        np.concatenate([h[3] for h in held]),
    )


def unpacked(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Keys, flags, rows, spots of the entries, then rows and spots of what is decided."""
    keys, flags, rows, spots, done_rows, done_spots = [], [], [], [], [], []
    for r in table.select(ENTRY_NAMES[1:]).to_pylist():
        ids = unplaned(r["rows"], "<i8")
        keys.append(unplaned(r["keys"], "<u8"))
        flags.append(np.frombuffer(r["flags"], np.uint8))
        rows.append(ids[unplaned(r["text"], "<u4")])
        spots.append(unplaned(r["spots"], SPOT))
        done_rows.append(ids[unplaned(r["done_text"], "<u4")])
        done_spots.append(unplaned(r["done_spots"], SPOT))
    return tuple(np.concatenate(x) for x in (keys, flags, rows, spots, done_rows, done_spots))


def repeated_entries(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    marks = np.zeros(len(keys), bool)
    marks[order[1:][same]] = True
    marks[order[:-1][same]] = True
    return marks


HIT_SCHEMA = "bucket int, rows binary, spots binary"
_BUCKETED = pa.schema([("bucket", pa.int32()), ("rows", pa.binary()), ("spots", pa.binary())])


def _bucketed(rows: np.ndarray, values: np.ndarray, buckets: int, name: str) -> pa.Table:
    """Values and their rows, packed by bucket of the row."""
    place = shard_of(rows.astype(np.int64).view(np.uint64), buckets)
    order = np.lexsort((rows, place))
    cuts = np.searchsorted(place[order], np.arange(buckets + 1))
    used = np.flatnonzero(cuts[1:] > cuts[:-1])
    parts = [order[cuts[i] : cuts[i + 1]] for i in used]
    return pa.table(
        {
            "bucket": pa.array(used, pa.int32()),
            "rows": pa.array([planes(rows[p].astype("<i8")) for p in parts], pa.binary()),
            name: pa.array([planes(values[p]) for p in parts], pa.binary()),
        }
    )


def _by_row(table: pa.Table, kind: np.dtype, by: str, name: str, joined: Callable[[np.ndarray], np.ndarray]) -> pa.Table:
    """The packed values of a bucket, one row per document."""
    rows = np.concatenate([unplaned(x.as_py(), "<i8") for x in table.column("rows")])
    values = np.concatenate([unplaned(x.as_py(), kind) for x in table.column(name)])
    order = np.lexsort((values[by], rows))
    rows, values = rows[order], values[order]
    head = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    packed = [joined(values[a:b]).tobytes() for a, b in zip(head, np.append(head[1:], len(rows)), strict=True)]
    return pa.table({"row": pa.array(rows[head], pa.int64()), name: pa.array(packed, pa.binary())})


def hot_limit(anchors: int) -> int:
    """Regions from which an anchor is hot, so that at most ``HOT_ANCHORS`` of so many are."""
    return max(HOT_REGIONS, anchors // HOT_ANCHORS)


def hot_keys(keys: np.ndarray, flags: np.ndarray, limit: int) -> np.ndarray:
    """Keys with ``limit`` entries or more; an entry counts with the copies its group has left out."""
    order = np.argsort(keys, kind="stable")
    head = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(keys) else np.zeros(0, np.int64)
    counts = np.add.reduceat(flags[order].astype(np.int64) + 1, head) if len(keys) else head
    return keys[order][head][counts >= limit]


def hits_table(rows: np.ndarray, spots: np.ndarray, buckets: int, hot: np.ndarray) -> pa.Table:
    """Spots by bucket of their rows, and the hot anchors, as HIT_SCHEMA."""
    found = _bucketed(rows, spots, buckets, "spots")
    if len(hot):
        row = {"bucket": HOT, "rows": planes(hot.astype("<u8")), "spots": b""}
        found = pa.concat_tables([found, pa.Table.from_pylist([row], _BUCKETED)])
    return found


def hot_of(hits: DataFrame) -> np.ndarray:
    """All hot anchors, sorted; ``hot_limit`` bounds their number."""
    found = [unplaned(bytes(r["rows"]), "<u8") for r in hits.where(F.col("bucket") == HOT).select("rows").collect()]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _each_once(spots: np.ndarray) -> np.ndarray:
    return spots[np.unique(spots["pos"], return_index=True)[1]]


def with_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows that have repeated anchors, with their packed spots."""

    def regrouped(table: pa.Table) -> pa.Table:
        return _by_row(table, SPOT, "pos", "spots", _each_once)

    listed = hits.where(F.col("bucket") != HOT).groupBy("bucket").applyInArrow(regrouped, "row long, spots binary")
    return rows.join(listed, "row")


def spots_of(batch: pa.RecordBatch, name: str = "spots") -> list[np.ndarray]:
    """Distinct spots of each row of a batch."""
    return [np.frombuffer(packed.as_py(), SPOT) for packed in batch.column(name)]


CONTEXT_SCHEMA = (
    "shard int, keys binary, text binary, starts binary, lengths binary, contexts binary, "
    "rows binary, ranks binary, done_text binary, done_starts binary, done_ends binary"
)
CONTEXT_NAMES = [part.split()[0] for part in CONTEXT_SCHEMA.split(", ")]


def contexts(
    rows: DataFrame, units: Callable, k: int, size: int, shards: int, keep_least: bool, hot: np.ndarray
) -> DataFrame:
    """Packed owned regions of the repeated anchors of (row, rank, text, spots).

    ``units`` gives hashes, first unit per text, and byte range of every unit.
    Of equal regions in a group of texts one is sent on and the others are
    decided: with ``keep_least``, those of a larger rank than the least; without,
    all of them.  The region of a ``hot`` anchor is cut into its windows, each a region
    whose key is its own hash.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        held_bytes = 0
        for batch in batches:
            ids, ranks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            spots = spots_of(batch)
            for texts in slices(batch.column(2)):
                found, first, byte_start, byte_end = units(texts)
                mine = spots[texts.rows]
                text = np.repeat(np.arange(len(mine)), [len(m) for m in mine])
                if not len(text):
                    continue
                flat = np.concatenate(mine)
                at = flat["pos"].astype(np.int64) + first[text]
                lo, last = at - flat["lo"], at - flat["hi"] + size
                ranges = RangeHash(found)
                keys = ranges.of(at, at + k)
                if len(shipped.value):
                    text, lo, last, keys = _cut(text, lo, last, keys, size, ranges, np.isin(keys, shipped.value))
                a, b = byte_start[lo], byte_end[last - 1]
                one = {
                    "keys": keys,
                    "text": text,
                    "start": lo - first[text],
                    "windows": last - lo - size + 1,
                    "size": b - a,
                    # mixed, as the key of a cut window may be the hash of its bytes itself
                    "mark": RangeHash(texts.bytes).of(a, b) ^ mixed(keys),
                    "bytes": texts.bytes[np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())],
                    "rows": ids[texts.rows],
                    "ranks": ranks[texts.rows],
                }
                held.append(one)
                held_bytes += len(one["bytes"])
                if held_bytes >= REGION_BYTES:
                    yield _context_rows(held, shards, size, keep_least)
                    held, held_bytes = [], 0
        if held:
            yield _context_rows(held, shards, size, keep_least)

    return rows.select("row", "rank", "text", "spots").mapInArrow(run, CONTEXT_SCHEMA)


def _cut(
    text: np.ndarray, lo: np.ndarray, last: np.ndarray, keys: np.ndarray, size: int, ranges: RangeHash, hot: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Regions with those marked ``hot`` replaced by their windows."""
    counts = (last - lo - size + 1)[hot]
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(lo[hot], counts) + offset
    return (
        np.concatenate([text[~hot], np.repeat(text[hot], counts)]),
        np.concatenate([lo[~hot], start]),
        np.concatenate([last[~hot], start + size]),
        np.concatenate([keys[~hot], ranges.of(start, start + size)]),
    )


def _context_rows(held: list[dict], shards: int, size: int, keep_least: bool) -> pa.RecordBatch:
    base = np.cumsum([0, *(len(h["rows"]) for h in held[:-1])])
    joined = {n: np.concatenate([h[n] for h in held]) for n in held[0] if n != "text"}
    text = np.concatenate([h["text"] + b for h, b in zip(held, base, strict=True)])
    keys, ranks = joined["keys"], joined["ranks"][text]
    order = np.lexsort((ranks, joined["mark"])) if keep_least else np.argsort(joined["mark"], kind="stable")
    marks = joined["mark"][order]
    head = np.append(True, marks[1:] != marks[:-1])
    group = np.cumsum(head) - 1
    if keep_least:
        decided = ranks[order] > ranks[order][np.flatnonzero(head)][group]
        sent = order[~decided]
    else:
        decided = np.bincount(group)[group] > 1
        sent = order[head]
    done = order[decided]
    place = shard_of(keys[sent], shards)
    by_shard = np.argsort(place, kind="stable")
    sent, cuts = sent[by_shard], np.searchsorted(place[by_shard], np.arange(shards + 1))
    where = text[done] % shards
    by_shard = np.argsort(where, kind="stable")
    done, done_cuts = done[by_shard], np.searchsorted(where[by_shard], np.arange(shards + 1))
    ends = np.cumsum(joined["size"])
    columns: list[list] = [[] for _ in CONTEXT_NAMES]
    for s in range(shards):
        a, b, c, d = cuts[s], cuts[s + 1], done_cuts[s], done_cuts[s + 1]
        if a == b and c == d:
            continue
        mine, ready = sent[a:b], done[c:d]
        used, local = np.unique(np.concatenate([text[mine], text[ready]]), return_inverse=True)
        local = local.astype("<u4")
        sizes = joined["size"][mine]
        pick = np.repeat(ends[mine] - sizes - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        starts = joined["start"][ready]
        values = (
            s,
            planes(keys[mine]),
            planes(local[: b - a]),
            planes(joined["start"][mine].astype("<u4")),
            planes(sizes.astype("<u4")),
            joined["bytes"][pick].tobytes(),
            planes(joined["rows"][used]),
            planes(joined["ranks"][used]),
            planes(local[b - a :]),
            planes(starts.astype("<u4")),
            planes((starts + joined["windows"][ready] + size - 1).astype("<u4")),
        )
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    kinds = [pa.int32(), *[pa.binary()] * 10]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], CONTEXT_NAMES)


class Contexts:
    """The owned regions of a shard, and the spans that are decided already."""

    def __init__(self, table: pa.Table) -> None:
        keys, starts, lengths, rows, ranks, data = [], [], [], [], [], []
        done_rows, done_starts, done_ends = [], [], []
        for r in table.select(CONTEXT_NAMES[1:]).to_pylist():
            ids, all_ranks = unplaned(r["rows"], "<i8"), unplaned(r["ranks"], "<i8")
            text = unplaned(r["text"], "<u4")
            keys.append(unplaned(r["keys"], "<u8"))
            starts.append(unplaned(r["starts"], "<u4").astype(np.int64))
            lengths.append(unplaned(r["lengths"], "<u4").astype(np.int64))
            data.append(np.frombuffer(r["contexts"], np.uint8))
            rows.append(ids[text])
            ranks.append(all_ranks[text])
            done_rows.append(ids[unplaned(r["done_text"], "<u4")])
            done_starts.append(unplaned(r["done_starts"], "<u4").astype(np.int64))
            done_ends.append(unplaned(r["done_ends"], "<u4").astype(np.int64))
        cat = np.concatenate
        self.keys, self.starts, self.rows, self.ranks = cat(keys), cat(starts), cat(rows), cat(ranks)
        self.bytes = cat(data)
        self.bounds = np.append(0, np.cumsum(cat(lengths)))
        self.done = cat(done_rows), cat(done_starts), cat(done_ends)


SPAN = np.dtype([("start", "<u4"), ("end", "<u4")])
SPAN_SCHEMA = "bucket int, rows binary, spans binary"


def spans_table(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> pa.Table:
    """Merged spans by bucket of their rows as SPAN_SCHEMA."""
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order], ends[order]
    head = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    parts = [merged(starts[a:b], ends[a:b]) for a, b in zip(head, np.append(head[1:], len(rows)), strict=False)]
    counts = [len(p) for p in parts]
    spans = np.concatenate(parts) if parts else np.zeros(0, SPAN)
    return _bucketed(np.repeat(rows[head], counts).astype(np.int64), spans, buckets, "spans")


def _united(spans: np.ndarray) -> np.ndarray:
    return merged(spans["start"].astype(np.int64), spans["end"].astype(np.int64))


def merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Union of spans that are sorted by start; touching spans are one."""
    if not len(starts):
        return np.zeros(0, SPAN)
    reach = np.maximum.accumulate(ends)
    head = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    found = np.empty(len(head), SPAN)
    found["start"], found["end"] = starts[head], reach[np.append(head[1:], len(starts)) - 1]
    return found


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """All rows, each with the packed spans found for it."""

    def regrouped(table: pa.Table) -> pa.Table:
        return _by_row(table, SPAN, "start", "spans", _united)

    return rows.join(spans.groupBy("bucket").applyInArrow(regrouped, "row long, spans binary"), "row", "left")


def spans_of(value) -> np.ndarray:
    """Merged spans of one row of ``with_spans``."""
    return np.zeros(0, SPAN) if value is None else np.frombuffer(value, SPAN)
