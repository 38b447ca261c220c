"""Placebo test: the uplift method run on normal weeks that are only labelled as promotions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.functions.columns import ratio
from shelflift.functions.intervals import clustered_total_ci
from shelflift.operators.uplift import PAIR, measurable
from shelflift.params import Params

PRIME = 1_000_003


def draw_order(product: Column, store: Column, week: Column, seed: Column) -> Column:
    """A scrambled number per (pair, week, seed); plain integer arithmetic, so any engine can repeat it."""
    h = (product * 7919 + store * 104729 + week * 1299709 + seed * 15485863) % PRIME
    return (h * (h + 12345) % PRIME) * (h + 777) % PRIME


def placebo_test(pairs: DataFrame, p: Params) -> DataFrame:
    """One row per run: average fake uplift per week and its range.

    Each measurable pair draws up to ``placebo_max_weeks`` (at most a quarter) of its normal weeks per run;
    the other normal weeks give the baseline. Whether a pair is measurable stands on each of its rows. A pair has at most ``tracked_weeks`` weeks, kept in two
    arrays, so the draws of all runs are row-local and only pair totals are aggregated.
    """
    known = pairs.where((F.col("promo_weeks") > 0) & measurable(p)).groupBy(*PAIR).agg(
        F.collect_list(F.when(F.col("promoted"), F.col("week_no"))).alias("promo"),
        F.map_from_entries(F.collect_list(
            F.when(~F.col("promoted"), F.struct("week_no", "adj_sales"))
        )).alias("sales"),
    )
    weeks = F.sequence(F.lit(p.first_week), F.lit(p.last_week))
    normal = (
        known.withColumn("normal", F.array_except(weeks, F.col("promo")))
        .withColumn("n", F.size("normal"))
        .withColumn("k", F.least(F.lit(p.placebo_max_weeks), F.floor(F.col("n") / 4).cast("int")))
        .withColumn("total", F.aggregate(F.map_values("sales"), F.lit(0.0), lambda a, v: a + v))
    )
    runs = normal.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(p.placebo_runs - 1))))
    order = F.array_sort(F.transform("normal", lambda w: F.struct(
        draw_order(F.col("product_id"), F.col("store_id").cast("bigint"), w.cast("bigint"),
                   F.col("seed").cast("bigint")).alias("h"),
        w.alias("w"),
    )))
    drawn = F.slice(order, F.lit(1), F.col("k"))
    fake = F.aggregate(
        drawn, F.lit(0.0), lambda a, d: a + F.coalesce(F.try_element_at(F.col("sales"), d["w"]), F.lit(0.0))
    )
    per_pair = runs.withColumn("fake", fake).withColumn(
        "extra", F.col("fake") - F.col("k") * (F.col("total") - F.col("fake")) / (F.col("n") - F.col("k"))
    )
    return per_pair.groupBy("seed").agg(
        F.count(F.lit(1)).alias("product_stores"),
        F.sum("k").alias("fake_weeks"),
        ratio(F.sum("extra"), F.sum("k")).alias("fake_extra_per_week"),
        (clustered_total_ci(F.col("extra"), p.z95) / F.sum("k")).alias("ci95"),
    ).withColumn("range_includes_zero", F.abs("fake_extra_per_week") <= F.col("ci95"))


def placebo_summary(runs: DataFrame) -> DataFrame:
    """Mean, smallest and largest fake uplift over the runs, and how many ranges include zero."""
    x = "fake_extra_per_week"
    return runs.agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg(x).alias("mean_fake_extra"),
        F.min(x).alias("min_fake_extra"),
        F.max(x).alias("max_fake_extra"),
        F.count_if("range_includes_zero").alias("ranges_with_zero"),
    )
