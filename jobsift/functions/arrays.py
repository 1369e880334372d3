"""Column helpers on arrays: one row holds one document, so nothing shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Without this, an array built in the same projection is rebuilt for every
    element a lambda looks at.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(values: Column, emit: Callable[[Column, Column, Column], Column]) -> Column:
    """Sort the values, then emit one struct per run of equal values.

    ``emit`` gets (value, count, first index in the unsorted array).
    """

    def over_sorted(items: Column) -> Column:
        size = F.size(items)

        def over_starts(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda start, k: emit(
                    F.get(items, start)["v"],
                    F.coalesce(F.get(starts, k + 1), size) - start,
                    F.get(items, start)["i"],
                ),
            )

        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda j: (j == 0) | (F.get(items, j)["v"] != F.get(items, j - 1)["v"]),
        )
        return F.when(size > 0, let(starts, over_starts))

    indexed = F.transform(values, lambda x, i: F.struct(x.alias("v"), i.alias("i")))
    return let(F.sort_array(indexed), over_sorted)


def most_common(values: Column, k: int) -> Column:
    """The k most frequent values; ties go to the value that appeared first."""
    ranked = F.sort_array(
        _runs(
            values,
            lambda v, n, i: F.struct((-n).alias("rank"), i.alias("first"), v.alias("v")),
        )
    )
    top = F.transform(F.slice(ranked, 1, k), lambda g: g["v"])
    return F.coalesce(top, F.array().cast("array<string>"))


def distinct_ignore_case(values: Column) -> Column:
    """First-seen distinct where case does not matter; the first spelling wins."""

    def over_values(original: Column) -> Column:
        lowered = F.transform(original, lambda x: F.lower(x))
        first_of_each = F.sort_array(
            _runs(lowered, lambda v, n, i: i)
        )
        return F.transform(first_of_each, lambda i: F.get(original, i))

    picked = F.when(F.size(values) > 1, let(values, over_values))
    return F.coalesce(picked, values)


def one_row_per_item(df: DataFrame, values: Column, name: str, *keep, pos: str | None = None) -> DataFrame:
    """Explode an array of non-null items, leaving out empty arrays.

    A plain explode makes the optimizer test the array's size in an extra filter
    below it, which computes a derived array twice.  The outer form does not.
    """
    if pos is None:
        rows = df.select(*keep, F.explode_outer(values).alias(name))
    else:
        rows = df.select(*keep, F.posexplode_outer(values).alias(pos, name))
    return rows.filter(F.col(name).isNotNull())


def slices(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of successive rows with at most ``limit`` units, or of one row."""
    ends, at = np.cumsum(lengths), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + limit, "right")), at + 1)
        yield at, to
        at = to
