"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm._store import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect the larger (or all smaller) neighbours of every node to its least neighbour."""
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = around.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def thinned(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components, for many sources (u) on few targets (v).

    A source keeps its least target, and its other targets are tied to that one.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v); the label is the least node reachable.

    Needs rounds in the logarithm of the longest path; every round is written,
    and one checksum row of it comes to the driver.
    """
    edges, before = stored(thinned(edges), "edges"), None
    while True:
        edges = stored(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
