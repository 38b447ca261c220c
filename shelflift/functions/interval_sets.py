"""Sets of intervals and running sums per key as sorted arrays, looked up by binary search.

A key's intervals (a household's campaigns, say) are merged to disjoint ones, at most as many as it has. Whether a range meets one of them takes one search then, instead of
a comparison with each or a join on a range condition, which multiplies rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def search_bits(ascending: Column) -> Column:
    """The bits that a count of the array's elements takes, highest first."""
    return F.sequence(F.length(F.bin(F.size(ascending))) - 1, F.lit(0))


def count_upto(ascending: Column, x: Column, bits: Column | None = None) -> Column:
    """How many elements of a sorted array are at most ``x``; 0 for a NULL array or ``x``. The count is built up from its highest bit.

    ``bits``: :func:`search_bits` of the array or of a longer one, for a caller that searches it several times.
    """
    bits = search_bits(ascending) if bits is None else bits

    def step(count: Column, bit: Column) -> Column:
        more = count + F.call_function("shiftleft", F.lit(1), bit)
        return F.when(F.get(ascending, more - 1) <= x, more).otherwise(count)

    return F.coalesce(F.aggregate(bits, F.lit(0), step), F.lit(0))


def holds(ascending: Column, x: Column) -> Column:
    """Whether a sorted array has ``x``; false for a NULL array."""
    return F.coalesce(F.get(ascending, count_upto(ascending, x) - 1) == x, F.lit(False))


def merged_intervals(rows: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """``(by, start, end)``: the disjoint intervals that cover what each key's intervals cover, both ends included.

    Intervals that share an end are one. Empty ones (end before start) and those with a NULL drop out. A key's intervals meet in one task.
    """
    ordered = Window.partitionBy(*by).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col(start) > F.max(end).over(ordered), F.lit(True)).cast("int")
    upto = Window.partitionBy(*by).orderBy(start, end).rowsBetween(Window.unboundedPreceding, 0)
    blocks = rows.where(F.col(start) <= F.col(end)).withColumn("_opens", opens).withColumn("_block", F.sum("_opens").over(upto))
    return blocks.groupBy(*by, "_block").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_block")


def interval_sets(rows: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """``(by, starts, ends)``: each key's disjoint intervals as two sorted arrays."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(start).alias("s"), F.col(end).alias("e"))))
    sets = merged_intervals(rows, by, start, end).groupBy(*by).agg(pairs.alias("_pairs"))
    return sets.select(*by, F.col("_pairs.s").alias("starts"), F.col("_pairs.e").alias("ends"))


def meets(starts: Column, ends: Column, low: Column, high: Column) -> Column:
    """Whether ``low`` to ``high`` has a point in common with an interval of the set; false for NULL arrays."""
    return F.coalesce(F.get(ends, count_upto(starts, high) - 1) >= low, F.lit(False))


def overlap_join(left: DataFrame, right: DataFrame, by: Sequence[str], low: str, high: str, start: str, end: str, anti: bool = False) -> DataFrame:
    """Rows of ``left`` whose range meets an interval of ``right`` with the same key, or (``anti``) those whose range meets none.

    An equijoin with one row per key and a search in it, so no row is multiplied and a frequent key of ``left`` can be split.
    """
    found = left.join(interval_sets(right, by, start, end), list(by), "left")
    met = meets(F.col("starts"), F.col("ends"), F.col(low), F.col(high))
    return found.where(~met if anti else met).select(*[F.col(f"`{c}`") for c in left.columns])
