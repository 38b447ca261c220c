"""Column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dollars(col: Column) -> Column:
    """An exact decimal amount as a double."""
    return col.cast("double")


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as a double, NULL when the denominator is zero or missing."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct_change(new: Column, old: Column) -> Column:
    """Relative change, NULL when there is nothing to compare with."""
    return ratio(new, old) - 1


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def sum_where(cond: Column, value: Column) -> Column:
    """Sum over the rows that satisfy ``cond``; NULL when there are none."""
    return F.sum(F.when(cond, value))


def label(names: dict[str, str], code: Column) -> Column:
    """The readable name of a code, NULL for a code that is not listed."""
    out = F.lit(None).cast("string")
    for key, name in names.items():
        out = F.when(code == key, name).otherwise(out)
    return out


def total(df: DataFrame, expr: Column) -> Column:
    """An aggregate of the whole of ``df`` as a scalar subquery, usable in another frame's expressions."""
    return df.agg(expr).scalar()


def deal(df: DataFrame, *by: str) -> DataFrame:
    """The rows dealt by hash of ``by``, so that aggregations, windows and joins on these columns (or, but for joins, on more) need no other exchange.

    Rows travel as they are, not summed before: meant for keys that repeat little within a task's input, where summing there keeps a task's whole
    input in memory and saves nothing. The number of partitions is the session's and is named, as otherwise adaptive execution joins partitions until their
    compressed bytes make a target, and a sort holds about ten times as many.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def constant_rows(df: DataFrame, name: str, values) -> DataFrame:
    """Repeat every row of ``df`` once per value of a short constant list."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
