"""Customer segments: recency, frequency and spend scores, churn flags, retention, coupon response."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window, functions as F

from shelflift.functions.columns import count_where, label, ratio, sum_where
from shelflift.functions.distributions import chi_square_p
from shelflift.functions.intervals import wilson
from shelflift.functions.ranking import ntiles
from shelflift.params import Params
from shelflift.schema import (
    AT_RISK, CHAMPIONS, FAIR_SCORE, HIGH_SCORE, INCOME_BANDS, LOST, LOYAL, NEEDS_ATTENTION, PROMISING,
)



def rfm_base(trips: DataFrame, p: Params) -> DataFrame:
    """Days since the last trip, number of trips and sales per household."""
    return trips.groupBy("household_key").agg(
        (p.last_day - F.max("day")).alias("days_since_last"),
        F.count(F.lit(1)).alias("trips"),
        F.sum("basket_value").alias("sales"),
    )


def trip_gaps(trips: DataFrame) -> DataFrame:
    """Days between one shopping day and the next (at most one row per household and day)."""
    days = trips.select("household_key", "day").distinct()
    previous = F.lag("day").over(Window.partitionBy("household_key").orderBy("day"))
    return days.withColumn("gap", F.col("day") - previous)


def gap_stats(gaps: DataFrame) -> DataFrame:
    """Median and 90th percentile gap, interpolated."""
    return (
        gaps.where(F.col("gap").isNotNull())
        .groupBy("household_key")
        .agg(F.percentile("gap", [0.5, 0.9]).alias("q"))
        .select("household_key", F.col("q")[0].alias("median_gap"), F.col("q")[1].alias("p90_gap"))
    )


def recent_13w(trips: DataFrame, p: Params) -> DataFrame:
    """Sales in the last 13 weeks and in the 13 weeks before."""
    last_start, prev_start = p.last_day - p.quarter_days, p.last_day - 2 * p.quarter_days
    zero = F.lit(0).cast("decimal(38,2)")
    last = sum_where(F.col("day") > last_start, F.col("basket_value"))
    prev = sum_where((F.col("day") > prev_start) & (F.col("day") <= last_start), F.col("basket_value"))
    return trips.groupBy("household_key").agg(
        F.coalesce(last, zero).alias("last_13w_sales"), F.coalesce(prev, zero).alias("prev_13w_sales")
    )


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintile scores 1-5 (5 is best); ties are ordered by household. ``base`` should be a stored table."""
    scores = {"r_score": ("days_since_last", True), "f_score": ("trips", False), "m_score": ("sales", False)}
    return ntiles(base, 5, scores, "household_key")


def segment(r: Column, f: Column) -> Column:
    recent, regular = r >= HIGH_SCORE, f >= FAIR_SCORE
    return (
        F.when(recent & (f >= HIGH_SCORE), CHAMPIONS)
        .when((r >= FAIR_SCORE) & regular, LOYAL)
        .when(recent, PROMISING)
        .when(r == FAIR_SCORE, NEEDS_ATTENTION)
        .when(regular, AT_RISK)
        .otherwise(LOST)
    )


def _quiet(days: Column, p90: Column, p: Params) -> Column:
    return days > F.greatest(2 * F.coalesce(p90, F.lit(float(p.default_gap))), F.lit(float(p.min_quiet_days)))


def household_rfm(scores: DataFrame, gaps: DataFrame, recent: DataFrame, p: Params) -> DataFrame:
    """Scores, segment, usual gaps, recent sales and the two churn-risk flags per household."""
    last, prev = F.col("last_13w_sales"), F.col("prev_13w_sales")
    return (
        scores.join(gaps, "household_key", "left")
        .join(recent, "household_key", "left")
        .select(
            "household_key", "days_since_last", "trips", F.round("sales", 2).alias("sales"),
            "r_score", "f_score", "m_score",
            segment(F.col("r_score"), F.col("f_score")).alias("segment"),
            "median_gap", "p90_gap", "last_13w_sales", "prev_13w_sales",
            _quiet(F.col("days_since_last"), F.col("p90_gap"), p).alias("gone_quiet"),
            ((prev > 0) & (last * 2 < prev)).alias("fading"),
        )
    )


def rfm_segment_summary(rfm: DataFrame) -> DataFrame:
    """Size, share of sales, averages and flags per segment."""
    per_segment = rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("households"),
        F.sum("sales").alias("all_sales"),
        F.avg("days_since_last").alias("days"),
        F.avg("trips").alias("avg_trips"),
        count_where(F.col("gone_quiet")).alias("gone_quiet"),
        count_where(F.col("fading")).alias("fading"),
    )
    everyone = rfm.agg(F.count(F.lit(1))).scalar()
    everything = rfm.agg(F.sum("sales")).scalar()
    return per_segment.select(
        "segment", "households",
        F.round(100 * ratio(F.col("households"), everyone), 1).alias("pct_households"),
        F.round(100 * ratio(F.col("all_sales"), everything), 1).alias("pct_sales"),
        F.round("days", 0).alias("avg_days_since_last"),
        F.round("avg_trips", 0).alias("avg_trips"),
        F.round(ratio(F.col("all_sales"), F.col("households")), 0).alias("avg_sales"),
        "gone_quiet", "fading",
        F.col("all_sales").alias("_order"),
    ).orderBy(F.desc("_order")).drop("_order")


def churn_flags(rfm: DataFrame) -> DataFrame:
    """Households and earlier sales behind each churn flag."""
    flags = {
        "gone quiet": F.col("gone_quiet"),
        "fading": F.col("fading"),
        "either": F.col("gone_quiet") | F.col("fading"),
    }
    measures = rfm.agg(
        F.count(F.lit(1)).alias("n"),
        *[count_where(c).alias(f"{k}_n") for k, c in flags.items()],
        *[F.sum(F.when(c, F.col("prev_13w_sales")).otherwise(0)).cast("double").alias(f"{k}_sales")
          for k, c in flags.items()],
    )
    rows = F.array(*[
        F.struct(F.lit(k).alias("flag"), F.col(f"{k}_n").alias("households"),
                 F.col(f"{k}_sales").alias("sales_at_risk_per_13w"),
                 ratio(F.col(f"{k}_n"), F.col("n")).alias("pct_households"))
        for k in flags
    ])
    return measures.select(F.explode(rows).alias("r")).select("r.*")


def churn_backtest(trips: DataFrame, p: Params) -> DataFrame:
    """Flag households with the history up to a past day, then see who came back."""
    past = F.col("day") <= p.backtest_day
    history = trips.where(past)
    last = history.groupBy("household_key").agg((p.backtest_day - F.max("day")).alias("days_since_last"))
    future = trips.where(~past).select("household_key").distinct().withColumn("came_back", F.lit(1))
    flagged = _quiet(F.col("days_since_last"), F.col("p90_gap"), p)
    rates = (
        last.join(gap_stats(trip_gaps(history)), "household_key", "left")
        .join(future, "household_key", "left")
        .withColumn("flagged", flagged)
        .groupBy("flagged")
        .agg(F.count(F.lit(1)).alias("households"), ratio(F.count("came_back"), F.count(F.lit(1))).alias("came_back"))
    )
    return rates.select(
        F.when(F.col("flagged"), f"flagged at day {p.backtest_day}").otherwise("not flagged").alias("churn_group"),
        "flagged", "households", "came_back", (1 - F.col("came_back")).alias("did_not_come_back"),
    )


def churn_backtest_ratio(backtest: DataFrame) -> DataFrame:
    """How many times likelier flagged households are not to come back."""
    lost = F.col("did_not_come_back")
    rates = backtest.agg(
        F.max(F.when(F.col("flagged"), lost)).alias("flagged_rate"),
        F.max(F.when(~F.col("flagged"), lost)).alias("unflagged_rate"),
    )
    floor = F.greatest("unflagged_rate", F.lit(1e-9))
    return rates.withColumn("times_likelier", F.col("flagged_rate") / floor)


def _retention(trips: DataFrame, p: Params, by: list[str]) -> DataFrame:
    quarter = F.floor((F.col("day") - 1) / p.quarter_days).cast("int") + 1
    active = trips.select("household_key", *by, quarter.alias("quarter")).distinct()
    following = F.lead("quarter").over(Window.partitionBy("household_key").orderBy("quarter"))
    per_quarter = (
        active.withColumn("stays", following == F.col("quarter") + 1)
        .groupBy(*by, "quarter")
        .agg(F.count(F.lit(1)).alias("active_households"), count_where(F.col("stays")).alias("stayed"))
    )
    has_next = per_quarter.select(*by, (F.col("quarter") - 1).alias("quarter"), F.lit(True).alias("has_next"))
    still = F.when(F.col("has_next"), F.col("stayed"))
    return per_quarter.join(has_next, [*by, "quarter"], "left").select(
        *by, "quarter", "active_households", still.alias("still_active_next_quarter"),
        ratio(still, F.col("active_households")).alias("retention_rate"),
    )


def retention_by_quarter(trips: DataFrame, p: Params) -> DataFrame:
    """Households active in a 13-week quarter and again in the next."""
    return _retention(trips, p, [])


def responder_retention(trips: DataFrame, redemptions: DataFrame, p: Params) -> DataFrame:
    """Quarter-to-quarter retention of households that redeemed a coupon and of the others."""
    responders = redemptions.select("household_key").distinct().withColumn("r", F.lit(True))
    marked = trips.select("household_key", "day").join(responders, "household_key", "left")
    return _retention(marked.withColumn("redeemed", F.coalesce("r", F.lit(False))), p, ["redeemed"])


def income_band(income: Column) -> Column:
    """Four reporting bands; NULL for a band that is not listed."""
    return label(INCOME_BANDS, income)


def household_income_bands(homes: DataFrame) -> DataFrame:
    return homes.where("has_demographics").select(
        "household_key", "income_desc", income_band(F.col("income_desc")).alias("income_band")
    )


OVERALL = "overall"
DEMOGRAPHICS = ["age_desc", "income_band", "hh_comp_desc", "kid_category_desc", "homeowner_desc"]


def redemption_by(homes: DataFrame, rfm: DataFrame) -> DataFrame:
    """Share of targeted households that redeemed a coupon, with its 95 % range.

    Over all targeted households, over those with demographics, by segment, and by each demographic over those that have any; one
    scan emits a household's groups.
    """
    targeted = (
        homes.join(rfm.select("household_key", "segment"), "household_key")
        .where(F.col("campaigns_received") > 0)
        .withColumn("income_band", income_band(F.col("income_desc")))
    )
    groups = F.array(
        F.struct(F.lit(OVERALL).alias("grouping"), F.lit("all targeted").alias("value")),
        F.struct(F.lit(OVERALL).alias("grouping"), F.when(F.col("has_demographics"), "with demographics").alias("value")),
        F.struct(F.lit("segment").alias("grouping"), F.col("segment").alias("value")),
        *[F.struct(F.lit(d).alias("grouping"), F.when(F.col("has_demographics"), F.col(d)).alias("value"))
          for d in DEMOGRAPHICS],
    )
    counted = (
        targeted.select((F.col("coupons_redeemed") > 0).alias("hit"), F.explode(groups).alias("g"))
        .where("g.value IS NOT NULL")
        .groupBy("g.grouping", "g.value")
        .agg(F.count(F.lit(1)).alias("households"), count_where(F.col("hit")).alias("redeemed"))
    )
    low, high = wilson(F.col("redeemed"), F.col("households"))
    return counted.select(
        "grouping", "value", "households", "redeemed",
        ratio(F.col("redeemed"), F.col("households")).alias("rate"), low.alias("ci_low"), high.alias("ci_high"),
    )


def redemption_chi_square(rates: DataFrame) -> DataFrame:
    """Do redemption rates differ between the groups of each grouping? (continuity correction for 2 groups)"""
    rates = rates.where(F.col("grouping") != OVERALL)
    totals = rates.groupBy("grouping").agg(
        F.sum("households").alias("n"), F.sum("redeemed").alias("r"), F.count(F.lit(1)).alias("k")
    )
    share = ratio(F.col("r"), F.col("n"))

    def part(observed: Column, expected: Column) -> Column:
        off = F.abs(observed - expected)
        off = F.when(F.col("k") == 2, off - F.least(F.lit(0.5), off)).otherwise(off)
        return F.try_divide(off * off, expected)

    hits, misses = F.col("redeemed"), F.col("households") - F.col("redeemed")
    stat = part(hits, F.col("households") * share) + part(misses, F.col("households") * (1 - share))
    return (
        rates.join(totals, "grouping")
        .groupBy("grouping")
        .agg(F.sum(stat).alias("chi_square"), (F.max("k") - 1).alias("dof"))
        .withColumn("p_value", chi_square_p("chi_square", "dof"))
    )
