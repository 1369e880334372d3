"""Mixing sources to target weights by weighted fair queueing.

Sources get targets by weight, cut at a number of passes over their own words.
Every copy of a shuffled document has a virtual finish time: the words of its
source up to and with it, divided by the target.  Copies are taken in the order
of finish times until the budget is spent.

The running sums are made per source and bucket of the shuffle order, then over
bucket totals, so a source that holds a third of all rows is no single task's.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsift.llm._store import free_name, stored

#: The weights that repeat over the sorted sources.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_PASSES = 3
SEED = "1"
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 20_000
TIME_BINS = 4096


def draw(docs: DataFrame, key: str, text: str, seed: str = SEED) -> Column:
    """Place in the shuffle: a hash of seed, key and text; equal rows draw equally."""
    return F.md5(
        F.concat(
            F.lit(f"{seed}:"),
            F.coalesce(docs[key].cast("string"), F.lit("")),
            F.lit(":"),
            F.coalesce(docs[text].cast("string"), F.lit("")),
        )
    )


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """Add rank, weight and target to (source, source_size), one row per source.

    All sizes together are shared by weight; a source stops at ``passes`` times
    its size and the excess is shared again.  Sorted by the share at which a
    source stops, the level of the others follows from running sums.  The window
    holds one row per source.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    named = F.array(*[F.lit(w) for w in weights])
    weighed = ranked.withColumn("weight", F.get(named, F.col("rank") % len(weights))).withColumn(
        "most", F.col("source_size") * passes
    )
    by_stop = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before, after = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    levelled = weighed.withColumn("place", F.row_number().over(by_stop)).withColumn("level", level)
    free = F.when(F.col("most") > F.col("weight") * F.col("level"), F.struct("place", "level"))
    share = F.col("weight") * F.min(free).over(every)["level"]
    return levelled.withColumn("target", F.least(F.coalesce(share, F.lit(0.0)), F.col("most").cast("double"))).select(
        "source", "source_size", "rank", "target"
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    passes: int = MAX_PASSES,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: key, mix_source, draw, size, source_size, target, ``finishes``.

    ``finishes`` has the finish time of each copy that the mix takes.  Null and
    empty texts have size 0 and are taken once or more at no cost.  Null is a
    source of its own, the last.  Equal rows tie: they are taken together or
    not at all.  Other columns are not read.
    """
    words = F.coalesce(F.regexp_count(docs[text].cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = stored(
        docs.select(
            docs[key].alias("key"),
            docs[source].cast("string").alias("source"),
            words.alias("size"),
            draw(docs, key, text, seed).alias("draw"),
        ),
        "mix-sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = stored(targets(sizes, weights, passes).join(sizes.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-sources")
    facts = sources.agg(F.max("n").alias("n"), F.sum("source_size").alias("budget")).first()
    digits = max(1, math.ceil(math.log(max(1, (facts["n"] or 0) / ROWS_PER_BUCKET), 16)))
    budget = facts["budget"] or 0

    placed = rows.withColumn("bucket", F.substring("draw", 1, digits))
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "size").rangeBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("inside", F.sum("size").over(inside))
    summed = summed.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    named = sources.select(F.col("source").alias("s"), "source_size", "rank", "target")
    summed = summed.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    upto = F.col("offset") + F.col("inside")

    def finish(turn: Column) -> Column:
        return F.coalesce(F.try_divide(turn * F.col("source_size") + upto, F.col("target")), F.lit(0.0))

    copies = F.transform(
        F.sequence(F.lit(0), F.lit(passes - 1)),
        lambda turn: F.struct(
            finish(turn).alias("finish"), F.col("rank"), turn.alias("turn"), F.col("draw"), F.col("size")
        ),
    )
    queued = stored(summed.select("key", "source", "draw", "size", "source_size", "target", copies.alias("copies")), "mix-queue")
    bin_of = lambda c: F.floor(F.least(c["finish"], F.lit(4.0)) * TIME_BINS)
    flat = queued.select(F.explode("copies").alias("c")).withColumn("bin", bin_of(F.col("c")))
    # One row per bin of finish times: at most 4 * TIME_BINS + 1 rows.
    totals = flat.groupBy("bin").agg(F.sum("c.size").alias("words"))
    running = totals.withColumn("upto", F.sum("words").over(Window.orderBy("bin")))
    cut = running.where(F.col("upto") > budget).orderBy("bin").limit(1).collect()
    last, spent = (cut[0]["bin"], cut[0]["upto"] - cut[0]["words"]) if cut else (4 * TIME_BINS + 2, 0)
    at_cut = flat.where(F.col("bin") == last).select(
        "c", F.sum("c.size").over(Window.partitionBy("bin").orderBy("c")).alias("upto")
    )
    edge = at_cut.where(F.col("upto") + spent <= budget).agg(F.max("c").alias("edge"))
    bounded = queued.join(F.broadcast(edge), how="left")  # one row
    taken = F.filter(
        "copies",
        lambda c: (bin_of(c) < last) | ((bin_of(c) == last) & F.coalesce(c <= F.col("edge"), F.lit(False))),
    )
    return bounded.select(
        F.col("key").alias(key),
        F.col("source").alias("mix_source"),
        "draw",
        "size",
        "source_size",
        "target",
        F.transform(taken, lambda c: c["finish"]).alias("finishes"),
    )


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The rows of the mix with all their columns, a row per copy taken, in the order of finish times."""
    seed = options.get("seed", SEED)
    # Equal rows have equal verdicts, so one per draw and source is joined back.
    verdict = mix(docs, text, source, key, **options).where(F.size("finishes") > 0)
    verdict = verdict.select("draw", "mix_source", "finishes").dropDuplicates(["draw", "mix_source"])
    names = [free_name(docs, stem) for stem in ("mix_draw", "mix_source", "mix_finishes", "mix_finish")]
    verdict = verdict.toDF(*names[:3])
    same = (draw(docs, key, text, seed) == verdict[names[0]]) & docs[source].cast("string").eqNullSafe(verdict[names[1]])
    copies = docs.join(verdict, same).withColumn(names[3], F.explode(names[2]))
    ordered = copies.repartitionByRange(names[3]).sortWithinPartitions(names[3])
    return ordered.select(*[F.col(f"`{c}`") for c in docs.columns])
