"""Centroid clustering over blocks of Hilbert-ordered vectors with zone maps.

Vectors are sorted along a Hilbert curve through all their dimensions, so that
neighbours in the order are near in space, and cut into blocks.  A block is one row
with its vectors and its box: the least and largest component of every dimension.
Distances of a box bound those of all its vectors, so a block is compared with the
centroids that may be nearest to one of them, often with one only.

Blocks are written once; a round is a scan of them that returns partial sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm._store import stored
from jobsift.llm.maxscore import quantised

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
#: Bits of a component on the curve, and vectors of a block.
CURVE_BITS = 4
BLOCK_ROWS = 128
ROWS_PER_PART = 1 << 16
#: Components below this are computed in 64 bits, others as Python integers.
_PLAIN = 1 << 26
_LONG = (1 << 63) - 1


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of ``cells`` (n x d, below 2^bits) on the Hilbert curve, as d * bits bits.

    The cells are turned into the transposed index by undoing the curve's
    rotations and reflections from the highest bit down, all rows at once; its bits
    are then interleaved, the highest of each dimension first.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    for high in range(bits - 1, 0, -1):
        q = np.uint32(1 << high)
        low = q - np.uint32(1)
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(flip, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turned = np.zeros(x.shape[1], np.uint32)
    for high in range(bits - 1, 0, -1):
        turned ^= np.where(x[n - 1] & np.uint32(1 << high), np.uint32((1 << high) - 1), np.uint32(0))
    x ^= turned
    planes = [(x >> np.uint32(b) & np.uint32(1)).astype(np.uint8).T for b in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes, axis=1), axis=1)
    return [row.tobytes() for row in packed]


def _matrix(lists: pa.ListArray) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(lists), -1)


def _keyed(least: int, largest: int):
    """Add the place on the curve; the range of all components is cut in 2^CURVE_BITS steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column("vector")).astype(np.float64)
                cells = np.floor((values - least) / (largest - least + 1) * (1 << CURVE_BITS))
                cells = np.clip(cells, 0, (1 << CURVE_BITS) - 1)
                keys = pa.array(hilbert_keys(cells, CURVE_BITS), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "place"])

    return run


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut sorted vectors into blocks: ids, vectors row by row, and the box."""
    for batch in batches:
        values, ids = _matrix(batch.column("vector")) if batch.num_rows else None, batch.column("id")
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = values[at : at + BLOCK_ROWS]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.slice(at, BLOCK_ROWS).to_pylist()], kind),
                    pa.array([part.ravel()], kind),
                    pa.array([part.min(0)], kind),
                    pa.array([part.max(0)], kind),
                ],
                ["ids", "vectors", "low", "high"],
            )


def _exact(values: np.ndarray) -> np.ndarray:
    return values if values.size == 0 or np.abs(values.astype(object)).max() < _PLAIN else values.astype(object)


@dataclass
class Centroids:
    """Centroids as integers; ``plain`` tells that all numbers fit 64-bit arithmetic."""

    points: list[list[int]]

    def __post_init__(self) -> None:
        big = max((abs(v) for p in self.points for v in p), default=0) >= _PLAIN
        self.matrix = np.array(self.points, object if big else np.int64).reshape(len(self.points), -1)

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Centroids that may be the nearest one of a vector in the box, ties included.

        One whose least distance from the box is above another's largest is out.  So is
        one that every point of the box is farther from than from the centroid nearest to
        the box's middle: the difference of the two distances is linear, so its least
        value lies in a corner.
        """
        c = self.matrix
        below, above = low - c, c - high
        gap = np.maximum(np.maximum(below, above), 0)
        reach = np.maximum(abs(c - low), abs(high - c))
        nearest = (gap * gap).sum(1)
        farthest = (reach * reach).sum(1)
        middle = 2 * c - (low + high)
        best = int(np.argmin((middle * middle).sum(1)))
        # |x - c|^2 - |x - best|^2 = 2 x (best - c) + |c|^2 - |best|^2
        slope = 2 * (c[best] - c)
        least = (np.where(slope > 0, low, high) * slope).sum(1) + (c * c).sum(1) - (c[best] * c[best]).sum()
        return np.flatnonzero((nearest <= farthest.min()) & (least <= 0))

    def assign(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each vector, the smaller number on ties, and the squared distance."""
        near = self.candidates(low, high)
        distance = np.empty((len(vectors), len(near)), vectors.dtype)
        for k, c in enumerate(near):
            away = vectors - self.matrix[c]
            distance[:, k] = (away * away).sum(1)
        choice = distance.argmin(1)
        return near[choice], distance[np.arange(len(vectors)), choice]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    ids, vectors, low, high = (batch.column(name) for name in ("ids", "vectors", "low", "high"))
    for i in range(batch.num_rows):
        own = ids[i].values
        flat = _exact(vectors[i].values.to_numpy(zero_copy_only=False).reshape(len(own), -1))
        box = [np.array(side[i].values.to_numpy(zero_copy_only=False), flat.dtype) for side in (low, high)]
        yield own, flat, *box


def _sums_of(points: list[list[int]]):
    """Per task: vectors and component sums of each cluster; sums are decimal text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points)
        counts = [0] * len(points)
        sums = np.zeros((len(points), len(points[0])), object)
        for batch in batches:
            for _, vectors, low, high in _blocks(batch):
                cluster, _ = centroids.assign(vectors, low, high)
                for c in np.unique(cluster):
                    own = vectors[cluster == c]
                    counts[c] += len(own)
                    sums[c] += own.sum(0).astype(object)
        used = [c for c, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array([counts[c] for c in used], pa.int64()),
                pa.array([[str(v) for v in sums[c]] for c in used], pa.list_(pa.string())),
            ],
            ["cluster", "n", "sums"],
        )

    return run


def _assigned_to(points: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points)
        for batch in batches:
            for ids, vectors, low, high in _blocks(batch):
                cluster, distance = centroids.assign(vectors, low, high)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(cluster, pa.int32()),
                        pa.array([min(int(d), _LONG) for d in distance], pa.int64()),
                    ],
                    ["id", "cluster", "distance"],
                )

    return run


def hilbert_blocks(vectors: DataFrame) -> DataFrame:
    """The table of blocks of (id, vector), in the order of the curve.

    Equal vectors have equal places, so the range also goes by a hash of the row: a
    vector that a third of all rows hold is spread over many parts.
    """
    stats = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.array_min("vector")).alias("least"), F.max(F.array_max("vector")).alias("largest")
    ).first()
    schema = "id long, vector array<long>, place binary"
    keyed = vectors.mapInArrow(_keyed(stats["least"] or 0, stats["largest"] or 0), schema)
    parts = max(-(-stats["n"] // ROWS_PER_PART), vectors.sparkSession.sparkContext.defaultParallelism)
    placed = keyed.withColumn("draw", F.xxhash64("id", F.monotonically_increasing_id()))
    ordered = placed.repartitionByRange(parts, "place", "draw").sortWithinPartitions("place", "draw")
    return ordered.drop("place", "draw").mapInArrow(
        _blocked, "ids array<long>, vectors array<long>, low array<long>, high array<long>"
    )


def cluster(
    rows: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) for every kept row.

    Kept are vectors of exactly ``dimensions`` components, none null or non-finite;
    components count as floor(scale * x), cut to a long.  The centroids start as the
    ``clusters`` kept vectors with the least sha256 of seed and key (null: empty), ties by the
    components; with fewer vectors there are fewer.  Each of ``rounds`` rounds assigns all
    vectors (squared distance, ties to the smaller number) and moves every non-empty centroid
    to floor(sum / count) in each component.  Rows with equal keys are rows of their own.  Distances
    beyond a long are cut.  An empty table gives no rows.  Other columns are not read.
    """
    wanted = F.when(F.size(rows[vector]) == dimensions, rows[vector])
    kept = rows.select(rows[key].cast("long").alias("id"), quantised(wanted, scale).alias("vector"))
    kept = kept.where("vector is not null")
    blocks = stored(hilbert_blocks(kept), "blocks")

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = kept.withColumn("draw", F.sha2(name, 256)).orderBy("draw", "vector").limit(clusters).select("vector")
    points = [list(r["vector"]) for r in first.collect()]
    schema = "id long, cluster int, distance long"
    if not points:
        empty = rows.sparkSession.createDataFrame([], schema)
        return empty.selectExpr("*", "0L AS cluster_inertia", "0L AS inertia", "array(0L) AS centroid")

    for _ in range(rounds):
        parts = blocks.mapInArrow(_sums_of(points), "cluster int, n long, sums array<string>")
        summed = parts.groupBy("cluster").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimensions)]
        )
        for row in summed.collect():
            points[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dimensions)]

    assigned = stored(blocks.mapInArrow(_assigned_to(points), schema), "clusters")
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    by_cluster = {r["cluster"]: min(int(r["inertia"]), _LONG) for r in inertia}
    total = min(sum(int(r["inertia"]) for r in inertia), _LONG)
    # One row per centroid; their number is a parameter.
    named = rows.sparkSession.createDataFrame(
        [(c, by_cluster.get(c, 0), total, points[c]) for c in range(len(points))],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return assigned.join(F.broadcast(named), "cluster")

