"""Exact best inner products by MaxScore over shards of vectors.

A dimension is a query term and its non-zero components are a posting list.  The
score bound of a term is its weight times the largest helpful component of the
list.  Terms in falling order of their bounds split in two: the non-essential ones
are the longest tail whose bounds together stay below the score to beat, so a
vector that only they could help cannot be among the best.  The essential lists are
traversed in full; the others are probed, term by term, only for vectors that can
still reach the score to beat.  It rises while a shard is searched.

Shards of vectors meet blocks of queries, each pair in a task's group, and the best
of every shard are merged by a ranking that keeps only that many per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsift.llm._store import stored

#: Components of a shard of vectors and of a block of queries.
SHARD_VALUES = 1 << 20
BLOCK_VALUES = 1 << 19
#: A list with at least this share of a shard's vectors is held as a full column.
DENSE = 0.25
_SEED_LISTS, _SEED_ROWS = 8, 16
_PROBES = 4
_LARGEST = 1 << 62


class Postings:
    """The posting lists of a shard.

    ``lists[d]`` is (vectors, components) of dimension ``d``; vectors is None where the
    list is a full column.  ``most`` and ``least`` are the extreme components of a list, at
    least 0 and at most 0 as vectors outside it count 0.
    """

    def __init__(self, sizes: np.ndarray, values: np.ndarray) -> None:
        self.rows = len(sizes)
        starts = np.cumsum(sizes) - sizes
        vector = np.repeat(np.arange(self.rows), sizes)
        dimension = np.arange(len(values)) - np.repeat(starts, sizes)
        order = np.argsort(dimension, kind="stable")
        order = order[values[order] != 0]
        self.dimensions, first = np.unique(dimension[order], return_index=True)
        self.place = {int(d): i for i, d in enumerate(self.dimensions)}
        self.lists, self.most, self.least, self.champions = [], [], [], []
        for at, to in zip(first, [*first[1:], len(order)]):
            vectors, components = vector[order[at:to]], values[order[at:to]]
            best = min(_SEED_ROWS, len(components))
            self.champions.append(
                tuple(vectors[np.argpartition(sign * components, best - 1)[:best]] for sign in (-1, 1))
            )
            self.most.append(max(int(components.max()), 0))
            self.least.append(min(int(components.min()), 0))
            if len(vectors) >= DENSE * self.rows:
                column = np.zeros(self.rows, np.int64)
                column[vectors] = components
                vectors, components = None, column
            self.lists.append((vectors, components))

    def add(self, scores: np.ndarray, place: int, weight) -> None:
        """Traverse a list."""
        vectors, components = self.lists[place]
        if vectors is None:
            scores += weight * components
        else:
            scores[vectors] += weight * components

    def probe(self, place: int, wanted: np.ndarray) -> np.ndarray:
        """Components of the wanted vectors in a list."""
        vectors, components = self.lists[place]
        if vectors is None:
            return components[wanted]
        at = np.minimum(np.searchsorted(vectors, wanted), len(vectors) - 1)
        return np.where(vectors[at] == wanted, components[at], 0)


def _best(postings: Postings, query: np.ndarray, own: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the shard with the ``top`` highest scores, and these; ``own`` is left out."""
    terms = [(postings.place[int(d)], int(query[d])) for d in np.flatnonzero(query) if int(d) in postings.place]
    bound = lambda t: t[1] * (postings.most if t[1] > 0 else postings.least)[t[0]]
    terms.sort(key=bound, reverse=True)
    bounds = [bound(t) for t in terms]
    reach = sum(abs(w) * max(postings.most[t], -postings.least[t]) for t, w in terms)
    kind = np.int64 if reach < _LARGEST else object

    # A first score to beat: the vectors on top of the strongest lists.
    score_to_beat = None
    seeds = [postings.champions[t][w < 0] for t, w in terms[:_SEED_LISTS]]
    seeds = np.unique(np.concatenate(seeds)) if seeds else np.zeros(0, np.int64)
    seeds = seeds[seeds != own]
    if len(seeds) >= top:
        exact = np.zeros(len(seeds), kind)
        for t, w in terms:
            exact += w * postings.probe(t, seeds).astype(kind, copy=False)
        score_to_beat = np.sort(exact)[-top]

    rest, least = [0] * (len(terms) + 1), [0] * (len(terms) + 1)
    for i in range(len(terms) - 1, -1, -1):
        t, w = terms[i]
        rest[i] = rest[i + 1] + bounds[i]
        least[i] = least[i + 1] + w * (postings.least if w > 0 else postings.most)[t]
    essential = len(terms)
    while score_to_beat is not None and essential and rest[essential - 1] < score_to_beat:
        essential -= 1

    scores = np.zeros(postings.rows, kind)
    for t, w in terms[:essential]:
        if kind is object:
            scores += w * postings.probe(t, np.arange(postings.rows)).astype(object)
        else:
            postings.add(scores, t, w)
    alive = np.arange(postings.rows)
    if score_to_beat is not None:
        alive = np.flatnonzero(scores + rest[essential] >= score_to_beat)
    alive = alive[alive != own]
    scores = scores[alive]
    for i in range(essential, len(terms)):
        t, w = terms[i]
        scores = scores + w * postings.probe(t, alive).astype(kind, copy=False)
        if (i - essential) % _PROBES == _PROBES - 1 or i == len(terms) - 1:
            if len(scores) > top:
                # As many vectors are sure of this score, whatever the other lists hold.
                score_to_beat = max(score_to_beat, np.partition(scores, -top)[-top] + least[i + 1])
            competitive = scores + rest[i + 1] >= score_to_beat
            alive, scores = alive[competitive], scores[competitive]
    # Vectors are numbered in the order that decides ties.
    order = np.argsort(-scores, kind="stable")[:top]
    return alive[order], scores[order]


def _vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    lists = table.column("vector").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    return sizes, lists.flatten().to_numpy().astype(np.int64)


_FOUND = pa.schema(
    [("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
)


def _searcher(top: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            return _FOUND.empty_table()
        vectors = vectors.sort_by([("id", "ascending"), ("row", "ascending")])
        postings = Postings(*_vectors(vectors))
        rows, ids = vectors.column("row").to_numpy(), vectors.column("id")
        place = {int(r): i for i, r in enumerate(rows)}
        sizes, values = _vectors(queries)
        starts = np.cumsum(sizes) - sizes
        asked = zip(queries.column("row").to_pylist(), queries.column("id").to_pylist(), starts, sizes)
        parts = []
        for row, key, at, n in asked:
            found, scores = _best(postings, values[at : at + n], place.get(row, -1), top)
            scores = [min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores]
            parts.append(
                pa.table(
                    [
                        pa.array([row] * len(found), pa.int64()),
                        pa.array([key] * len(found), pa.int64()),
                        pa.array(rows[found]),
                        ids.take(pa.array(found)).combine_chunks(),
                        pa.array(scores, pa.int64()),
                    ],
                    schema=_FOUND,
                )
            )
        return pa.concat_tables(parts)

    return search


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * component) of each component, null if any is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(finite, whole)


def best_products(
    vectors: DataFrame,
    asked: Column,
    top: int = 5,
    scale: int = 256,
    vector: str = "embedding",
    key: str = "vec_id",
    shard_values: int = SHARD_VALUES,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` highest inner products of each row for which ``asked`` is true.

    Components count as floor(scale * x).  All rows but the query's own are candidates;
    fewer are returned if there are fewer.  Ties go to the smaller key, null last, and
    then to one of the rows.  A vector that is null or holds a null or non-finite
    component takes no part.  Vectors of different lengths meet in the dimensions both
    have; an empty one scores 0 with all.  Of rows with equal keys each is a query and a
    candidate of its own.  Products beyond 62 bits are summed exactly and cut to a long;
    components beyond a long are cut before.  An empty table gives no rows.  Other columns are not read.
    """
    whole = vectors.select(
        vectors[key].cast("long").alias("id"), quantised(vectors[vector], scale).alias("vector"), asked.alias("asked")
    ).where("vector is not null")
    rows = stored(whole.withColumn("row", F.monotonically_increasing_id()), "vectors")
    values = F.size("vector") + 1
    total = rows.agg(F.sum(values).alias("all"), F.sum(F.when(F.col("asked"), values)).alias("asked")).first()
    shards = -(-(total["all"] or 0) // shard_values) or 1
    blocks = -(-(total["asked"] or 0) // block_values) or 1

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(n)))
        every = F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))
        return placed.withColumn(other, F.explode(every)).select("shard", "block", "row", "id", "vector")

    candidates = dealt(rows, "shard", shards, "block", blocks).groupBy("shard", "block")
    queries = dealt(rows.where("asked"), "block", blocks, "shard", shards).groupBy("shard", "block")
    found = candidates.cogroup(queries).applyInArrow(
        _searcher(top), "query_row long, query_id long, vec_row long, vec_id long, score long"
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
