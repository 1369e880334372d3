"""How the sources of a language differ in their words: a joint quadtree traversal.

The count matrix of a language has a row per source and a column per kept term.
It is cut into blocks of columns, and each block is a forest of K-squared trees
(K = 2): a node has a bit for each quadrant that holds a count, a child's place is
the rank of its bit, and an all-zero quadrant has no node.

All pairs of sources descend their trees together.  Where both quadrants are empty
every pair of their rows has the smoothed share of an absent term on both sides,
so the quadrant is a number of columns times one price per pair.  Cells that
at least one side has are priced by themselves.

A share is ``p = 1 + floor(SCALE * (count + 1) / (total + terms))`` and the price of a
term ``floor((p - q)^2 / q)``; both are computed in integers or decimals only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsift.limits import MAX_BROADCAST_ROWS, lookup_join
from jobsift.llm._store import stored
from jobsift.llm._words import slices

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
#: Counts of one block of columns, and rows of one band of sources.
BLOCK_CELLS = 1 << 18
BAND_ROWS = 1024
BROADCAST_BYTES = 32 << 20
_SCAN_BYTES = 1 << 20
_HELD_ROWS = 1 << 19
_FRONTIER = 1 << 17

#: Bytes of a term, letters and everything beyond ASCII.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def _terms(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Terms of a slice of texts in order, and the text of each."""
    inside = TERM_BYTES[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    letters = _FOLD[data[inside]]
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters))
    return terms, np.searchsorted(bounds, start, "right") - 1


def _summed(parts: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    found = pa.concat_tables(parts).group_by(keys).aggregate([("n", "sum"), ("docs", "sum")])
    return found.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: occurrences and documents of each (lang, source, term), partly summed."""
    held: list[pa.Table] = []
    rows = 0

    def batch(table: pa.Table) -> Iterator[pa.RecordBatch]:
        return iter(table.combine_chunks().to_batches(max_chunksize=1 << 16))

    for source in batches:
        columns = [source.column(i).cast(pa.large_string()) for i in (0, 1)]
        for texts in slices(source.column(2), _SCAN_BYTES):
            words, text = _terms(texts.bytes, texts.bounds)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            n = len(coded.dictionary)
            pairs, counts = np.unique(text * n + coded.indices.to_numpy(), return_counts=True)
            # Rows of one slice with equal lang and source are one group.
            names = pa.table({"lang": columns[0][texts.rows], "source": columns[1][texts.rows]})
            names = names.append_column("at", pa.array(np.arange(len(names))))
            groups = names.group_by(["lang", "source"]).aggregate([("at", "min"), ("at", "list")])
            lists = groups.column("at_list").combine_chunks()
            group = np.empty(len(names), np.int64)
            group[lists.flatten().to_numpy()] = np.repeat(np.arange(len(groups)), pc.list_value_length(lists).to_numpy())
            cells, inverse = np.unique(group[pairs // n] * n + pairs % n, return_inverse=True)
            occurrences = np.zeros(len(cells), np.int64)
            np.add.at(occurrences, inverse, counts)
            at = pa.array(cells // n)
            held.append(
                pa.table(
                    {
                        "lang": groups.column("lang").take(at).cast(pa.string()),
                        "source": groups.column("source").take(at).cast(pa.string()),
                        "term": coded.dictionary.take(pa.array(cells % n)).cast(pa.string()),
                        "n": occurrences,
                        "docs": np.bincount(inverse, minlength=len(cells)).astype(np.int64),
                    }
                )
            )
            rows += len(cells)
            if rows > _HELD_ROWS:
                held = [_summed(held)]
                rows = len(held[0])
                if rows > _HELD_ROWS // 2:
                    yield from batch(held[0])
                    held, rows = [], 0
    if held:
        yield from batch(_summed(held))


@dataclass
class Tree:
    """Quadtrees of a block: ``kids[l][i, k]`` is the place of quadrant k of node i, or -1.

    Level 0 holds the cells, with shares ``p``; the last row of every level has no quadrants,
    so that -1 leads to -1.
    """

    kids: list[np.ndarray]
    roots: np.ndarray
    p: np.ndarray
    absent: np.ndarray


def _tree(row: np.ndarray, column: np.ndarray, p: np.ndarray, absent: np.ndarray, levels: int, tiles: int) -> Tree:
    code = column >> levels
    for bit in range(levels - 1, -1, -1):
        code = code << 2 | (row >> bit & 1) << 1 | column >> bit & 1
    order = np.argsort(code)
    nodes, kids = code[order], [np.zeros((0, 4), np.int64)]
    for _ in range(levels):
        above = np.unique(nodes >> 2)
        bits = np.zeros(4 * len(above), bool)
        bits[4 * np.searchsorted(above, nodes >> 2) + (nodes & 3)] = True
        rank = np.where(bits, np.cumsum(bits) - 1, -1).reshape(-1, 4)
        kids.append(np.vstack([rank, np.full((1, 4), -1)]))
        nodes = above
    roots = np.full(tiles, -1)
    roots[nodes] = np.arange(len(nodes))
    return Tree(kids, roots, p[order], absent)


def _priced(a: Tree, b: Tree, levels: int, columns: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Prices of all pairs of rows over all columns: of (row of a, row of b) and the other way.

    With ``same`` trees only pairs of a row and a later one are filled.
    """
    high, wide = len(a.absent), len(b.absent)
    forward, backward = np.zeros(high * wide, np.int64), np.zeros(high * wide, np.int64)
    empty = [np.zeros((-(-high // (1 << l)), -(-wide // (1 << l))), np.int64) for l in range(levels + 1)]
    tiles = len(a.roots)
    zero = np.zeros(tiles, np.int64)
    both = (a.roots < 0) & (b.roots < 0)
    empty[levels][0, 0] += int(both.sum()) << levels
    stack = [(levels, a.roots[~both], b.roots[~both], zero[~both], zero[~both])]
    while stack:
        level, x, y, i, j = stack.pop()
        if len(x) > _FRONTIER:
            half = len(x) // 2
            stack += [(level, x[:half], y[:half], i[:half], j[:half]), (level, x[half:], y[half:], i[half:], j[half:])]
        elif level:
            parts = []
            for down in range(8):
                di, dj, dc = down >> 2, down >> 1 & 1, down & 1
                ni, nj = 2 * i + di, 2 * j + dj
                real = (ni << (level - 1) < high) & (nj << (level - 1) < wide)
                if same:
                    real &= ni <= nj
                ni, nj = ni[real], nj[real]
                nx, ny = a.kids[level][x[real], 2 * di + dc], b.kids[level][y[real], 2 * dj + dc]
                none = (nx < 0) & (ny < 0)
                counts = empty[level - 1]
                counts += np.bincount(
                    ni[none] * counts.shape[1] + nj[none], minlength=counts.size
                ).reshape(counts.shape) << (level - 1)
                some = ~none
                parts.append((nx[some], ny[some], ni[some], nj[some]))
            stack.append((level - 1, *(np.concatenate(column) for column in zip(*parts))))
        elif len(x):
            if same:
                other = i != j
                x, y, i, j = x[other], y[other], i[other], j[other]
            p = np.where(x >= 0, np.append(a.p, 0)[x], a.absent[i])
            q = np.where(y >= 0, np.append(b.p, 0)[y], b.absent[j])
            square = (p - q) * (p - q)
            np.add.at(forward, i * wide + j, square // q)
            np.add.at(backward, i * wide + j, square // p)
    absent = sum(
        np.repeat(np.repeat(counts, 1 << l, 0), 1 << l, 1)[:high, :wide] for l, counts in enumerate(empty)
    ) - ((tiles << levels) - columns)
    square = (a.absent[:, None] - b.absent[None, :]) ** 2
    forward = forward.reshape(high, wide) + absent * (square // b.absent[None, :])
    backward = backward.reshape(high, wide) + absent * (square // a.absent[:, None])
    return forward, backward


_PRICES = pa.schema(
    [("lang", pa.string()), ("place", pa.int64()), ("other", pa.int64()), ("value", pa.int64()), ("seen", pa.int64())]
)


def _block_prices(lang, low: int, high: int, table: pa.Table) -> pa.Table:
    """All pairs of a band of sources and another over the columns of a block that either has.

    Columns of other bands only are not seen here; ``seen`` tells how many were.
    """
    heads = table.filter(pc.is_null(table.column("term")))
    cells = table.filter(pc.is_valid(table.column("term")))
    place, p = cells.column("place").to_numpy(), cells.column("p").to_numpy()
    coded = pc.dictionary_encode(cells.column("term").combine_chunks())
    column, columns = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    # Terms of the same sources side by side, so that empty quadrants are large.
    first, last = np.full(columns, np.iinfo(np.int64).max), np.zeros(columns, np.int64)
    np.minimum.at(first, column, place)
    np.maximum.at(last, column, place)
    moved = np.empty(columns, np.int64)
    moved[np.lexsort((last, first))] = np.arange(columns)
    column = moved[column]
    absent_place, absent_p = heads.column("place").to_numpy(), heads.column("p").to_numpy()
    levels = max(int(min(BAND_ROWS, len(absent_place)) - 1).bit_length(), 1)
    tiles = -(-columns // (1 << levels))

    def tree(band: int) -> tuple[Tree, np.ndarray]:
        rows = np.sort(absent_place[absent_place // BAND_ROWS == band])
        absent = np.empty(len(rows), np.int64)
        at = absent_place // BAND_ROWS == band
        absent[absent_place[at] % BAND_ROWS] = absent_p[at]
        own = place // BAND_ROWS == band
        return _tree(place[own] % BAND_ROWS, column[own], p[own], absent, levels, tiles), rows

    a, rows = tree(low)
    b, others = (a, rows) if low == high else tree(high)
    forward, backward = _priced(a, b, levels, columns, low == high)
    i, j = np.triu_indices(len(rows), 1) if low == high else np.indices(forward.shape).reshape(2, -1)
    return pa.table(
        {
            "lang": pa.array([lang] * (2 * len(i)), pa.string()),
            "place": np.concatenate([rows[i], others[j]]),
            "other": np.concatenate([others[j], rows[i]]),
            "value": np.concatenate([forward[i, j], backward[i, j]]),
            "seen": np.full(2 * len(i), columns),
        },
        schema=_PRICES,
    )


def _prices_of(key: tuple, table: pa.Table) -> pa.Table:
    return _block_prices(key[0].as_py(), key[2].as_py(), key[3].as_py(), table)


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a term, exact: 1 + floor(SCALE * (count + 1) / (total + terms))."""
    whole = "decimal(20,0)"
    scaled = (count.cast(whole) + F.lit(1).cast("decimal(1,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast(whole) + terms.cast(whole)
    return (F.call_function("div", scaled, below) + F.lit(1)).cast("long")


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and rows of each term; nulls are empty."""
    wide = docs.select(
        *[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    )
    parts = wide.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs.

    Part ``pair`` has each other source of the language by the sum of prices over all kept
    terms; part ``term`` the ``top`` terms of which the source has a larger share than
    its language.  Null text, lang and source are empty strings.  Every row is a
    document of its own, repeated or not.  A source without terms has a share of each
    kept term as any other; a language without kept terms has pairs of value 0.  Ties
    go by the bytes of the item.  An empty table gives no rows.  Other columns are not
    read.  A text of any length is scanned in one piece.
    """
    counts = stored(term_counts(docs, text, lang, source), "term-counts")
    by_term = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("in_sources")
    )
    kept = by_term.where(F.col("docs") >= least_documents).drop("docs")
    cells = stored(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"), F.sum("in_sources").alias("cells")
    )
    occurring = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit("")).alias("lang"),
        F.coalesce(docs[source].cast("string"), F.lit("")).alias("source"),
    ).distinct()
    by_size = Window.partitionBy("lang").orderBy(F.desc("total"), "source")
    named = (
        occurring.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["total", "terms", "lang_total", "cells"])
        .withColumn("place", F.row_number().over(by_size).cast("long") - 1)
        .withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang")))
        .withColumn("blocks", F.ceil(F.col("cells") / block_cells).cast("int"))
        .withColumn("bands", F.ceil(F.col("sources") / BAND_ROWS).cast("int"))
        .withColumn("absent", F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))))
    )
    groups = stored(named, "groups")
    size = groups.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length("lang") + F.octet_length("source")).alias("bytes"),
    ).first()
    small = size["rows"] if (size["bytes"] or 0) <= BROADCAST_BYTES else MAX_BROADCAST_ROWS + 1

    group = F.struct("lang", "source").alias("group")
    facts = lookup_join(
        cells.select(group, "term", "n", "lang_n"), groups.select(group, *groups.columns), "group", F.col("term"), table_rows=small
    ).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))

    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    price = F.expr("(p - q) * (p - q) div q")
    over = facts.withColumn("q", q).where("p > q").select("lang", "source", F.col("term").alias("item"), price.alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    def in_bands(df: DataFrame) -> DataFrame:
        band = (F.col("place") / BAND_ROWS).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), F.col("bands") - 1),
            lambda y: F.struct(F.least(band, y).alias("low"), F.greatest(band, y).alias("high")),
        )
        return df.select("lang", "block", "place", "term", "p", F.explode(pairs).alias("pair")).select(
            "lang", "block", "pair.low", "pair.high", "place", "term", "p"
        )

    dealt = facts.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    heads = groups.where("blocks > 0").select(
        "lang", "place", "bands", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"),
    )
    prices = (
        in_bands(dealt)
        .unionByName(in_bands(heads))
        .groupBy("lang", "block", "low", "high")
        .applyInArrow(_prices_of, "lang string, place long, other long, value long, seen long")
    )
    summed = prices.groupBy("lang", "place", "other").agg(
        F.sum(F.col("value").cast("decimal(20,0)")).alias("value"), F.sum("seen").alias("seen")
    )
    left = groups.select("lang", "source", "place", "terms", F.col("absent").alias("p"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("absent").alias("q"))
    absent = F.expr("(terms - seen) * ((p - q) * (p - q) div q)")
    pairs = (
        left.join(right, "lang")
        .where("place <> other")
        .join(summed, ["lang", "place", "other"], "left")
        .select("lang", "source", "item", F.coalesce((F.col("value") + absent).cast("long"), F.lit(0)).alias("value"))
        .withColumn("rank", F.row_number().over(best))
    )
    part = lambda df, name: df.select(
        "lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")
    )
    return part(pairs, "pair").unionByName(part(terms, "term"))
