"""Promotion uplift against a seasonally adjusted baseline per product and store.

Everything after the season index works on one frame, the promotion timeline: a row for every week in
which a product sold in a tracked store or was promoted there. One window over (product, store), at most
``tracked_weeks`` rows each, supplies what would otherwise take a join per step: sale weeks, promo weeks,
normal sales and the following week.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelflift.functions.columns import count_where, deal, label, ratio, sum_where
from shelflift.functions.intervals import clustered_total_ci
from shelflift.params import Params
from shelflift.schema import (
    BOTH, DISPLAY_NAMES, DISPLAY_ONLY, FREE_ITEM_MAILERS, LEVEL_DISPLAY, LEVEL_MAILER, LEVEL_TYPE,
    MAILER_NAMES, MAILER_ONLY,
)

PAIR = ["product_id", "store_id"]
CATEGORY = ["department", "commodity_desc", "sub_commodity_desc"]


def season_index(weekly: DataFrame, p: Params) -> DataFrame:
    """How busy a week is for a department relative to its average week, limited to [floor, cap].

    All sales of all stores count. The average is over the weeks the department has sales in.
    """
    totals = (
        weekly.where(F.col("week_no").between(p.first_week, p.last_week))
        .groupBy("department", "week_no")
        .agg(F.sum("sales").cast("double").alias("sales"))
    )
    mean = F.avg("sales").over(Window.partitionBy("department"))
    idx = F.least(F.greatest(F.col("sales") / mean, F.lit(p.season_floor)), F.lit(p.season_cap))
    return totals.select("department", "week_no", idx.alias("season_idx"))


def promo_type() -> Column:
    return (
        F.when(F.col("on_display") & F.col("in_mailer"), BOTH)
        .when(F.col("on_display"), DISPLAY_ONLY)
        .otherwise(MAILER_ONLY)
    )


def adjusted_weeks(weekly: DataFrame, season: DataFrame) -> DataFrame:
    """Tracked sale weeks with sales divided by the season index (1 where a week has none)."""
    return (
        weekly.where("promo_tracked")
        .join(season, ["department", "week_no"], "left")
        .withColumn("adj_sales", F.col("sales").cast("double") / F.coalesce("season_idx", F.lit(1.0)))
    )


def ps_weeks(weekly: DataFrame, season: DataFrame) -> DataFrame:
    """Season-adjusted weekly sales in tracked stores and weeks."""
    return adjusted_weeks(weekly, season).select(
        *PAIR, "week_no", *CATEGORY, "sales", "discount", "adj_sales",
        (F.col("on_display") | F.col("in_mailer")).alias("promoted"),
    )


def promotion_timeline(weeks: DataFrame, promotions: DataFrame, p: Params) -> DataFrame:
    """Sale weeks and promoted weeks side by side, one row per product, store and week.

    ``weeks`` is the result of :func:`ps_weeks`. A promoted week without a sale has NULL ``adj_sales``;
    a week without promotion has NULL ``promo_type``. Both sides are put under one another and dealt once, by product and
    store; that serves the rows of a week and every later window over the pair. A full outer join would lose the partitioning.
    """
    promoted = promotions.where(
        (F.col("on_display") | F.col("in_mailer")) & F.col("week_no").between(p.first_week, p.last_week)
    ).select(*PAIR, "week_no", "display", "mailer", promo_type().alias("promo_type"))
    sold = weeks.select(*PAIR, "week_no", *CATEGORY, "discount", "adj_sales")
    rows = deal(sold.unionByName(promoted, allowMissingColumns=True), *PAIR)
    values = [*CATEGORY, "discount", "adj_sales", "display", "mailer", "promo_type"]
    return rows.groupBy(*PAIR, "week_no").agg(*[F.max(v).alias(v) for v in values])


def pair_timeline(timeline: DataFrame, p: Params) -> DataFrame:
    """The timeline with pair totals and the following week on every row; ``first_row`` marks one row of each pair.

    Pairs that never sold in a tracked week drop out.
    """
    ordered = Window.partitionBy(*PAIR).orderBy("week_no")
    # Same partitioning and order as `ordered`, so that one sort serves all expressions.
    pair = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sold, promoted = F.col("adj_sales").isNotNull(), F.col("promo_type").isNotNull()
    follows = F.lead("week_no").over(ordered) == F.col("week_no") + 1
    return (
        timeline.withColumns({
            **{c: F.max(c).over(pair) for c in CATEGORY},
            "sale_weeks": F.count("adj_sales").over(pair),
            "promo_weeks": F.count("promo_type").over(pair),
            "nonpromo_sales": F.sum(F.when(~promoted, F.col("adj_sales"))).over(pair),
            "next_sales": F.when(follows, F.lead("adj_sales").over(ordered)),
            "next_promoted": F.when(follows, F.lead(promoted).over(ordered)),
            "first_row": F.lag("week_no").over(ordered).isNull(),
        })
        .where(F.col("sale_weeks") > 0)
        .withColumns({"sold": sold, "promoted": promoted,
                      "normal_weeks": p.tracked_weeks - F.col("promo_weeks")})
        .withColumn("baseline_weekly", ratio(F.coalesce("nonpromo_sales", F.lit(0.0)), F.col("normal_weeks")))
    )


def ps_candidates(weeks: DataFrame, p: Params) -> DataFrame:
    """Product-stores that sell often enough; promoted and normal weeks both count towards the minimum."""
    return (
        weeks.groupBy(*PAIR, *CATEGORY)
        .agg(
            sum_where(~F.col("promoted"), F.col("adj_sales")).alias("nonpromo_sales"),
            F.count(F.lit(1)).alias("sale_weeks"),
        )
        .where(F.col("sale_weeks") >= p.min_sale_weeks)
        .drop("sale_weeks")
    )


def promo_weeks(pairs: DataFrame, p: Params) -> DataFrame:
    """Promoted weeks of the candidate pairs, with or without a sale."""
    return pairs.where(F.col("promoted") & (F.col("sale_weeks") >= p.min_sale_weeks)).select(
        *PAIR, "week_no", "display", "mailer", "promo_type"
    )


def measurable(p: Params) -> Column:
    return (F.col("sale_weeks") >= p.min_sale_weeks) & (F.col("normal_weeks") >= p.min_normal_weeks)


def baseline(pairs: DataFrame, p: Params) -> DataFrame:
    """Normal weekly sales of each measurable pair that was promoted at all.

    Divided by all normal weeks, not only by those with a sale.
    """
    return pairs.where(F.col("first_row") & (F.col("promo_weeks") > 0) & measurable(p)).select(
        *PAIR, *CATEGORY, "promo_weeks", "normal_weeks", "baseline_weekly")


def promo_week_uplift(pairs: DataFrame, p: Params) -> DataFrame:
    """Actual sales, baseline and extra sales of every promoted week of the measurable pairs.

    ``next_week_change`` is the next week's sales minus the baseline when that week is inside the tracked
    weeks and not promoted.
    """
    actual = F.coalesce("adj_sales", F.lit(0.0))
    base = F.col("baseline_weekly")
    free_next = (F.col("week_no") < p.last_week) & ~F.coalesce("next_promoted", F.lit(False))
    zero = F.lit(0).cast("decimal(20,2)")
    return pairs.where(F.col("promoted") & measurable(p)).select(
        *PAIR, "week_no", "promo_type", "display", "mailer", *CATEGORY,
        actual.alias("actual_sales"),
        base.alias("baseline_weekly"),
        (actual - base).alias("incremental_sales"),
        F.coalesce(F.col("discount"), zero).alias("discount"),
        F.when(free_next, F.coalesce("next_sales", F.lit(0.0)) - base).alias("next_week_change"),
    )


def pull_forward(uplift: DataFrame) -> DataFrame:
    """The change in the week after a promotion, where it can be measured."""
    return uplift.where(F.col("next_week_change").isNotNull()).select(*PAIR, "week_no", "next_week_change")


def uplift_summary(uplift: DataFrame, p: Params) -> DataFrame:
    """Uplift by promotion type, by display location and by mailer placement.

    Every row is tagged with its one or two levels in one scan. Weeks of a product-store share a
    baseline, so the range is built from pair totals.
    """
    detail = F.when(
        F.col("promo_type") == DISPLAY_ONLY,
        F.struct(F.lit(LEVEL_DISPLAY).alias("level"), F.col("display").alias("placement")),
    ).when(
        F.col("promo_type") == MAILER_ONLY,
        F.struct(F.lit(LEVEL_MAILER).alias("level"), F.col("mailer").alias("placement")),
    )
    by_type = F.struct(F.lit(LEVEL_TYPE).alias("level"), F.col("promo_type").alias("placement"))
    per_pair = (
        uplift.withColumn("tag", F.explode(F.array_compact(F.array(by_type, detail))))
        .groupBy("tag.level", "tag.placement", *PAIR)
        .agg(
            F.count(F.lit(1)).alias("weeks"),
            F.sum("baseline_weekly").alias("base"),
            F.sum("actual_sales").alias("actual"),
            F.sum("incremental_sales").alias("extra"),
            F.sum("next_week_change").alias("after"),
            F.sum("discount").alias("given"),
        )
    )
    s = {c: F.sum(c) for c in ("weeks", "base", "actual", "extra", "after", "given")}
    return per_pair.groupBy("level", "placement").agg(
        s["weeks"].alias("promo_weeks"),
        F.count(F.lit(1)).alias("product_stores"),
        F.round(s["base"], 0).alias("baseline_sales"),
        F.round(s["actual"], 0).alias("actual_sales"),
        F.round(s["extra"], 0).alias("extra_sales"),
        F.round(100 * ratio(s["extra"], s["base"]), 1).alias("uplift_pct"),
        F.round(ratio(s["extra"], s["weeks"]), 3).alias("avg_extra_per_week"),
        F.round(clustered_total_ci(F.col("extra"), p.z95) / s["weeks"], 3).alias("ci95"),
        F.round(s["after"], 0).alias("after_promo_change"),
        F.round(s["extra"] + F.coalesce(s["after"], F.lit(0.0)), 0).alias("net_extra_sales"),
        F.round(s["given"], 0).cast("double").alias("discount_given"),
        F.round(ratio(s["extra"], s["given"]), 2).alias("extra_per_discount_dollar"),
    ).orderBy("level", F.desc("extra_sales"))


def uplift_by_type_share(summary: DataFrame) -> DataFrame:
    """The promotion types with their share of all extra sales."""
    types = summary.where(F.col("level") == LEVEL_TYPE)
    everything = types.agg(F.sum("extra_sales")).scalar()
    return types.select(
        "placement", "promo_weeks", "extra_sales", ratio(F.col("extra_sales"), everything).alias("share_of_extra"),
        "uplift_pct", "avg_extra_per_week", "ci95", "extra_per_discount_dollar",
    )


def uplift_additivity(summary: DataFrame) -> DataFrame:
    """Does display + mailer give the sum of display only and mailer only?"""
    def of(kind: str) -> Column:
        return F.max(F.when(F.col("placement") == kind, F.col("avg_extra_per_week")))

    return summary.where(F.col("level") == LEVEL_TYPE).agg(
        of(BOTH).alias("both"), of(MAILER_ONLY).alias("mailer_only"), of(DISPLAY_ONLY).alias("display_only")
    ).withColumn("sum_of_singles", F.col("mailer_only") + F.col("display_only")).withColumn(
        "difference", F.col("both") - F.col("sum_of_singles")
    )


def placement_labels(summary: DataFrame) -> DataFrame:
    """Summary rows with readable names; mailer codes outside the list (free items) drop out."""
    name = (
        F.when(F.col("level") == LEVEL_TYPE, F.col("placement"))
        .when(F.col("level") == LEVEL_DISPLAY, label(DISPLAY_NAMES, F.col("placement")))
        .otherwise(label(MAILER_NAMES, F.col("placement")))
    )
    prefix = F.when(F.col("level") == LEVEL_DISPLAY, "Display: ").when(
        F.col("level") == LEVEL_MAILER, "Mailer: ").otherwise("")
    return (
        summary.withColumn("position", name)
        .where((F.col("level") != LEVEL_MAILER) | F.col("position").isNotNull())
        .select(
            "level", "placement", "position", F.concat(prefix, F.col("position")).alias("name"),
            "promo_weeks", "extra_sales", "avg_extra_per_week", "ci95", "extra_per_discount_dollar",
        )
    )


def placement_highlights(labels: DataFrame) -> DataFrame:
    """Front page against interior page, and the spread between display locations."""
    mailer, display = F.col("level") == LEVEL_MAILER, F.col("level") == LEVEL_DISPLAY

    def mail(code: str, column: str) -> Column:
        return F.max(F.when(mailer & (F.col("placement") == code), F.col(column)))

    avg = F.when(display, F.col("avg_extra_per_week"))
    return labels.agg(
        ratio(mail("D", "avg_extra_per_week"), mail("A", "avg_extra_per_week")).alias("front_to_interior"),
        ratio(mail("A", "promo_weeks"), sum_where(mailer, F.col("promo_weeks"))).alias("interior_share"),
        count_where(display).alias("display_locations"),
        F.min(avg).alias("display_min"),
        F.max(avg).alias("display_max"),
    )


def bi_promo_uplift(summary: DataFrame) -> DataFrame:
    """Readable uplift table for dashboards, without the free-item mailer placements."""
    code = F.col("placement")
    level = F.when(F.col("level") == LEVEL_TYPE, "Promotion type").when(
        F.col("level") == LEVEL_DISPLAY, "Display location").otherwise("Mailer placement")
    name = (
        F.when(F.col("level") == LEVEL_TYPE, code)
        .when(F.col("level") == LEVEL_DISPLAY, F.coalesce(label(DISPLAY_NAMES, code), code))
        .otherwise(F.coalesce(label(MAILER_NAMES, code), code))
    )
    avg, ci = F.col("avg_extra_per_week"), F.col("ci95")
    return summary.where(~((F.col("level") == LEVEL_MAILER) & code.isin(FREE_ITEM_MAILERS))).select(
        level.alias("level"), name.alias("placement"), "promo_weeks", "extra_sales", "uplift_pct",
        "avg_extra_per_week", "ci95", (avg - ci).alias("ci_low"), (avg + ci).alias("ci_high"),
        "net_extra_sales", "discount_given", "extra_per_discount_dollar",
    )
