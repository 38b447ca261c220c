"""Design and reading of the randomised coupon test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelflift.functions.columns import constant_rows, count_where, ratio
from shelflift.functions.distributions import group_size_for_power
from shelflift.functions.intervals import Z_POWER_80, Z_TWO_SIDED_95
from shelflift.functions.ranking import running_total
from shelflift.params import Params
from shelflift.schema import AT_RISK

TEST, CONTROL = "test", "control"
# Fixed values of the draw: the largest prime below 2^53, two multipliers and an offset.
PRIME, MULTIPLIER, SALT_MULTIPLIER, OFFSET = 9_007_199_254_740_881, 6_364_136_223_846_793, 1_442_695_040_888_963, 777_767_777
Z_SUM = Z_TWO_SIDED_95 + Z_POWER_80


def experiment_pool(dim: DataFrame) -> DataFrame:
    """Households that are at risk or carry a churn flag."""
    return dim.where((F.col("segment") == AT_RISK) | F.col("churn_risk")).select("household_key", "segment")


def weekly_spend(trips: DataFrame, first_week: int, last_week: int) -> DataFrame:
    """Average weekly spend of the households that shopped in the weeks."""
    return (
        trips.where(F.col("week_no").between(first_week, last_week))
        .groupBy("household_key")
        .agg((F.sum("basket_value").cast("double") / (last_week - first_week + 1)).alias("spend"))
    )


def ab_pool_stats(pool: DataFrame, trips: DataFrame, p: Params) -> DataFrame:
    """Size, mean and spread of weekly spend for the whole pool and per segment; no trip counts as 0."""
    spend = weekly_spend(trips, p.pool_first_week, p.pool_last_week)
    rows = pool.join(spend, "household_key", "left").withColumn("spend", F.coalesce("spend", F.lit(0.0)))
    return (
        rows.withColumn("pool", F.explode(F.array(F.lit("all"), F.col("segment"))))
        .groupBy("pool")
        .agg(
            F.count(F.lit(1)).alias("households"),
            F.avg("spend").alias("mean_weekly_spend"),
            F.stddev_samp("spend").alias("sd_weekly_spend"),
        )
    )


def ab_sample_size(stats: DataFrame, p: Params) -> DataFrame:
    """Households per group to detect a relative lift (5 % two-sided, 80 % power, normal form)."""
    scaled = ratio(F.col("sd_weekly_spend"), F.col("lift_to_detect") * F.col("mean_weekly_spend"))
    per_group = F.ceil(2 * F.pow(Z_SUM * scaled, F.lit(2))).cast("bigint")
    return (
        constant_rows(stats, "lift_to_detect", p.lifts)
        .withColumn("households_per_group", per_group)
        .select(
            "pool", "lift_to_detect",
            (F.col("lift_to_detect") * F.col("mean_weekly_spend")).alias("lift_dollars_per_week"),
            "households_per_group", (2 * F.col("households_per_group")).alias("total_households"),
        )
    )


def ab_sample_size_exact(stats: DataFrame, p: Params) -> DataFrame:
    """As :func:`ab_sample_size`, but solved for the power of the t test itself (noncentral t); NULL without a mean or a spread."""
    effect = ratio(F.col("lift_to_detect") * F.col("mean_weekly_spend"), F.col("sd_weekly_spend"))
    size = group_size_for_power(effect, F.lit(0.05), F.lit(0.8))
    return (
        constant_rows(stats, "lift_to_detect", p.lifts)
        .withColumn("households_per_group", F.when(~F.isnan(size), size.cast("bigint")))
        .select("pool", "lift_to_detect", "households_per_group", (2 * F.col("households_per_group")).alias("total_households"))
    )


def ab_sample_size_prop(backtest: DataFrame, p: Params) -> DataFrame:
    """Households per group to see the keep rate of flagged households rise by some points.

    The base rate is the share of flagged households that came back in the back-test.
    """
    base = F.col("keep_rate")

    def angle(rate: Column) -> Column:
        return 2 * F.asin(F.sqrt(rate))

    target = F.least(base + p.keep_rate_gain, F.lit(1.0))
    effect = angle(target) - angle(base)
    return backtest.where("flagged").select(F.col("came_back").alias("keep_rate")).select(
        "keep_rate", target.alias("target_rate"), effect.alias("effect_size"),
        F.ceil(2 * F.pow(F.try_divide(F.lit(Z_SUM), effect), F.lit(2))).cast("bigint").alias("households_per_group"),
    )


def draw(key: Column, salt: int) -> Column:
    """A number below 2^53 that no other key below ``PRIME`` shares.

    A linear map and cubing are one-to-one modulo this prime, as 3 does not divide PRIME - 1; exact decimals hold the products.
    """
    def mod(x: Column) -> Column:
        return (x % PRIME).cast("decimal(16,0)")

    def cubed(x: Column) -> Column:
        return mod(mod(x * x) * x)

    start = mod(key.cast("decimal(19,0)") * F.lit(MULTIPLIER).cast("decimal(16,0)") + F.lit(salt * SALT_MULTIPLIER % PRIME + OFFSET).cast("decimal(17,0)"))
    return cubed(mod(cubed(start) + OFFSET)).cast("bigint")


def ab_assignment(pool: DataFrame, salt: int = 17) -> DataFrame:
    """Half of each segment at random to the offer, the other half to control.

    Households are ordered by a salted scramble of their key and dealt out in turn, so the split is exact
    within a segment and can be repeated. The order comes from bucketed ranks: a segment of any size is
    never sorted in one task.
    """
    scrambled = draw(F.col("household_key"), salt)
    dealt = running_total(
        pool.withColumn("_draw", scrambled), "_draw", "household_key", by=["segment"], out="_rn", total="_n"
    )
    return dealt.select(
        "household_key", "segment", F.when(F.col("_rn") % 2 == 1, TEST).otherwise(CONTROL).alias("arm")
    )


def ab_balance(assignment: DataFrame, trips: DataFrame, p: Params) -> DataFrame:
    """Arms per segment before the test: households, average weekly spend and trips, and the arm's share of the segment."""
    weeks = p.pool_last_week - p.pool_first_week + 1
    before = (
        trips.where(F.col("week_no").between(p.pool_first_week, p.pool_last_week))
        .groupBy("household_key")
        .agg(F.sum("basket_value").alias("spend"), F.count(F.lit(1)).alias("trips"))
    )
    arms = (
        assignment.join(before, "household_key", "left")
        .groupBy("segment", "arm")
        .agg(
            F.count(F.lit(1)).alias("households"),
            F.coalesce(F.sum("spend"), F.lit(0).cast("decimal(38,2)")).alias("spend"),
            F.coalesce(F.sum("trips"), F.lit(0)).alias("trips"),
        )
    )
    n, both = F.col("households"), F.sum("households").over(Window.partitionBy("segment"))
    return arms.select(
        "segment", "arm", "households", ratio(F.col("spend") * 100, n * weeks * 100).alias("mean_weekly_spend"),
        ratio(F.col("trips"), n * weeks).alias("mean_weekly_trips"), ratio(n, both).alias("share_of_segment"))


def ab_readout(
    assignment: DataFrame, trips: DataFrame, lines: DataFrame, first_week: int, weeks: int = 8, follow_weeks: int = 4,
    z: float = Z_TWO_SIDED_95,
) -> DataFrame:
    """Difference in weekly spend with its 95 % range, share still shopping, coupon cost and the decision.

    Roll out when the whole range clears the coupon cost per household and week, extend when it is above
    zero but not clear of the cost, stop when it includes zero.
    """
    last_week = first_week + weeks - 1
    spend = weekly_spend(trips, first_week, last_week)
    later = (
        trips.where(F.col("week_no").between(last_week + 1, last_week + follow_weeks))
        .select("household_key").distinct().withColumn("later", F.lit(1))
    )
    coupons = (
        lines.where(F.col("week_no").between(first_week, last_week))
        .groupBy("household_key")
        .agg(F.sum(F.col("coupon_disc") + F.col("coupon_match_disc")).alias("coupons"))
    )
    rows = (
        assignment.join(spend, "household_key", "left")
        .join(later, "household_key", "left")
        .join(coupons, "household_key", "left")
        .withColumn("spend", F.coalesce("spend", F.lit(0.0)))
    )

    def arm(fn, column: str, name: str) -> Column:
        return fn(F.when(F.col("arm") == name, F.col(column)))

    measures = rows.agg(
        count_where(F.col("arm") == TEST).alias("n1"),
        count_where(F.col("arm") == CONTROL).alias("n0"),
        arm(F.avg, "spend", TEST).alias("m1"),
        arm(F.avg, "spend", CONTROL).alias("m0"),
        arm(F.var_samp, "spend", TEST).alias("v1"),
        arm(F.var_samp, "spend", CONTROL).alias("v0"),
        arm(F.count, "later", TEST).alias("l1"),
        arm(F.count, "later", CONTROL).alias("l0"),
        arm(F.sum, "coupons", TEST).cast("double").alias("c1"),
    )
    c = F.col
    half = z * F.sqrt(ratio(c("v1"), c("n1")) + ratio(c("v0"), c("n0")))
    decision = (
        F.when(c("ci_low") > c("coupon_cost_per_household_week"), "roll out")
        .when(c("ci_low") > 0, "extend")
        .otherwise("stop")
    )
    return measures.select(
        c("n1").alias("test_households"), c("n0").alias("control_households"),
        c("m1").alias("test_weekly_spend"), c("m0").alias("control_weekly_spend"),
        (c("m1") - c("m0")).alias("difference"),
        (c("m1") - c("m0") - half).alias("ci_low"), (c("m1") - c("m0") + half).alias("ci_high"),
        ratio(c("l1"), c("n1")).alias("test_still_shopping"),
        ratio(c("l0"), c("n0")).alias("control_still_shopping"),
        (ratio(F.coalesce(c("c1"), F.lit(0.0)), c("n1")) / weeks).alias("coupon_cost_per_household_week"),
    ).withColumn("decision", decision)
