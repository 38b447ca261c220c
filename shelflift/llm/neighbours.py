"""Each row together with the next one in descending id order, without sorting the table in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

_LOWEST = -(1 << 63)
_PER_TASK = 8


def _bucket(bounds: list[int], x: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``x``, looked up in two steps."""
    step = math.isqrt(len(bounds)) + 1
    numbers = lambda some: F.split(F.lit(",".join(map(str, some))), ",").cast("array<bigint>")
    coarse = F.size(F.filter(numbers(bounds[step - 1::step]), lambda b: b <= x)) * step if len(bounds) >= step else F.lit(0)
    return (coarse + F.size(F.filter(F.slice(numbers(bounds), coarse + 1, F.lit(step)), lambda b: b <= x))) if bounds else F.lit(0)


def descending(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bucket, look, id, text), partitioned by bucket and sorted by (bucket, look, id descending, text).

    Within a bucket, the row after the last one with ``look`` 0 is its successor: each bucket also holds, with ``look`` 1, the
    rows that follow it in the order, which for the bucket with the smallest ids are the rows with the largest. Null ids
    come last and equal ids by text. Buckets are cut at quantiles of the id; only their bounds and largest ids reach the driver.
    """
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("order"), F.col(id_col).cast("long").alias("id"),
                     F.col(text_col).cast("string").alias("text"))
    n = _PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = rows.select("order").stat.approxQuantile("order", [i / n for i in range(1, n)], 0.2 / n)
    dealt = rows.withColumn("bucket", _bucket(sorted({int(b) for b in bounds}), F.col("order")))
    heads = dealt.groupBy("bucket").agg(F.max("order").alias("order")).orderBy("bucket").collect()
    # The largest id of each bucket and the bucket whose last row it follows: one row per bucket.
    follow = [(h["order"], heads[(i + 1) % len(heads)]["bucket"]) for i, h in enumerate(heads)]
    after = F.broadcast(spark.createDataFrame(follow, "order long, other int"))
    copies = F.filter(F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("look")), F.struct(F.col("other").alias("bucket"), F.lit(1).alias("look"))),
        lambda x: x["bucket"].isNotNull())
    spread = dealt.join(after, "order", "left").select(F.explode(copies).alias("to"), "order", "id", "text")
    return (spread.select("to.bucket", "to.look", "order", "id", "text").repartition("bucket")
            .sortWithinPartitions("bucket", "look", F.desc("order"), "text").select("bucket", "look", "id", "text"))
