"""What may be broadcast, and what happens to larger sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.session import stored

# Rows of a two-string dictionary that are safe in every executor (some tens of MB).
MAX_BROADCAST_ROWS = 200_000
# Parts of the facts that a task of a join gets: a key with more than one is spread.
PARTS_PER_TASK = 8
# Parts over which facts without a key are spread, as they meet nothing.
NULL_PARTS = 1 << 16


def small_rows(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> list | None:
    """The rows of ``df`` when there are at most ``limit`` of them, else None.

    At most ``limit + 1`` rows ever reach the driver.
    """
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def row_groups(rows: DataFrame, words: Column, size: int) -> DataFrame:
    """The written rows with ``_group``: neighbours of one file, some ``size`` words on average.

    ``_row`` is what ``monotonically_increasing_id`` gave the rows when they were written.
    """
    total = rows.agg(F.sum(words), F.count(F.lit(1))).first()
    per_group = max(int(size * total[1] // max(total[0] or 0, 1)), 1)
    # the id has the task in its upper bits and the place of the row below
    place = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    group = F.shiftright("_row", 33) * F.lit(1 << 33) + F.floor(place / F.lit(per_group))
    return rows.withColumn("_group", group.cast("long"))


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread: Column,
    how: str = "inner",
    table_rows: int | None = None,
) -> DataFrame:
    """Join facts to a table that has one row per key.

    A table proven to have at most ``MAX_BROADCAST_ROWS`` rows is broadcast.
    A larger one is shuffled, after it is reduced to the keys that occur.
    """
    if table_rows is not None and table_rows <= MAX_BROADCAST_ROWS:
        return facts.join(F.broadcast(table), key, how)
    return spread_join(facts, table, key, spread, how)


def spread_join(
    facts: DataFrame, table: DataFrame, key: str, spread: Column, how: str = "inner"
) -> DataFrame:
    """A shuffled join in which a heavy key has as many copies as its facts need tasks.

    The facts are counted per key.  A part is the share of the facts that a task
    should get, divided by ``PARTS_PER_TASK``; a key with more facts than one part is
    spread over just enough copies of its row, and all others have one.  At most as
    many keys as there are parts can be heavy, so their list is small by construction.
    """
    counts = stored(facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = max(total / (PARTS_PER_TASK * tasks), 1)
    heavy = F.broadcast(counts.filter(F.col("_n") > part).select(key, F.ceil(F.col("_n") / part).cast("int").alias("_copies")))
    copies = F.coalesce("_copies", F.lit(1))
    hashed = F.xxhash64(spread)
    salted = (
        facts.join(heavy, key, "left")
        .withColumn("_salt", F.pmod(hashed, F.when(F.col(key).isNull(), NULL_PARTS).otherwise(copies)).cast("int"))
        .drop("_copies")
    )
    occurring = table.join(counts.select(key), key, "left_semi").join(heavy, key, "left")
    spread_rows = occurring.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies")
    return salted.join(spread_rows, [key, "_salt"], how).drop("_salt")
