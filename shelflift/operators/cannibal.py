"""Cannibalisation: did a promotion grow its sub-category or take sales from similar products?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelflift.functions.columns import count_where, ratio, sum_where
from shelflift.functions.intervals import clustered_total_ci
from shelflift.operators.uplift import PAIR
from shelflift.params import Params
from shelflift.schema import (
    ALL_PROMOTIONS, BOTH, CANNIBAL_DEPARTMENT, CANNIBAL_OVERALL, CANNIBAL_TYPE, DISPLAY_ONLY, MAILER_ONLY, MIXED,
)

SUBCAT_STORE = ["department", "sub_commodity_desc", "store_id"]


def ps_all_baseline(pairs: DataFrame, p: Params) -> DataFrame:
    """Normal weekly sales of every product-store that ever sold and was not promoted all the time."""
    return pairs.where(F.col("first_row") & (F.col("promo_weeks") < p.tracked_weeks)).select(
        *PAIR, "department", "sub_commodity_desc",
        F.coalesce("nonpromo_sales", F.lit(0.0)).alias("nonpromo_sales"), "promo_weeks", "baseline_weekly")


def _extra():
    return F.coalesce("adj_sales", F.lit(0.0)) - F.col("baseline_weekly")


def _has_baseline(p: Params):
    return F.col("promoted") & (F.col("promo_weeks") < p.tracked_weeks)


def promoted_product_weeks(pairs: DataFrame, p: Params) -> DataFrame:
    """Extra sales of each promoted product in each promoted week."""
    return pairs.where(_has_baseline(p)).select(
        *PAIR, "week_no", "department", "sub_commodity_desc", "promo_type", _extra().alias("extra")
    )


def subcat_weeks(pairs: DataFrame, p: Params) -> DataFrame:
    """Sales of a sub-category in a store and week, and what the promoted products added.

    Sales and promotions sit on the same timeline rows, so one aggregation gives what a full outer join of
    two totals would. Names that are NULL match nothing: for them sales and promotion stay separate rows.
    """
    promo = _has_baseline(p)
    # The types of a week as bits: unlike text, an integer can be combined inside a hash aggregation.
    kinds = {BOTH: 1, DISPLAY_ONLY: 2, MAILER_ONLY: 4}
    type_bit = F.coalesce(*[F.when(F.col("promo_type") == k, bit) for k, bit in kinds.items()])
    grouped = (
        pairs.where(F.col("sold") | promo)
        .groupBy(*SUBCAT_STORE, "week_no")
        .agg(
            count_where(F.col("sold")).alias("sold_rows"),
            F.sum("adj_sales").alias("total_sales"),
            sum_where(promo, _extra()).alias("promoted_extra"),
            count_where(promo).alias("promoted_products"),
            F.bit_or(F.when(promo, type_bit)).alias("types"),
        )
    )
    promoted = F.col("promoted_products") > 0
    unnamed = F.col("department").isNull() | F.col("sub_commodity_desc").isNull()
    split = unnamed & promoted & (F.col("sold_rows") > 0)
    total = F.coalesce("total_sales", F.lit(0.0)).alias("total_sales")
    single = F.coalesce(*[F.when(F.col("types") == bit, k) for k, bit in kinds.items()])
    kind = F.coalesce(single, F.lit(MIXED)).alias("promo_type")
    products = F.col("promoted_products")

    def with_promo(sales):
        return F.struct(sales, F.lit(True).alias("promo_week"), F.col("promoted_extra").alias("promoted_extra"),
                        products.alias("promoted_products"), kind)

    sales_only = F.struct(
        total, F.lit(False).alias("promo_week"), F.lit(None).cast("double").alias("promoted_extra"),
        F.lit(None).cast("bigint").alias("promoted_products"), F.lit(None).cast("string").alias("promo_type"),
    )
    rows = (
        F.when(split, F.array(sales_only, with_promo(F.lit(0.0).alias("total_sales"))))
        .when(promoted, F.array(with_promo(total)))
        .otherwise(F.array(sales_only))
    )
    return grouped.select(*SUBCAT_STORE, "week_no", F.explode(rows).alias("r")).select(
        *SUBCAT_STORE, "week_no", "r.*"
    )


def _normal_sales():
    return sum_where(~F.col("promo_week"), F.col("total_sales"))


def _filled(normal, missing_baseline: str):
    return F.coalesce(normal, F.lit(0.0)) if missing_baseline == "zero" else normal


def subcat_baseline(weeks: DataFrame, p: Params, missing_baseline: str = "null") -> DataFrame:
    """Normal weekly sales of a sub-category in a store over weeks with none of its products promoted.

    A sub-category that only has promoted weeks on record gets a NULL baseline, or 0 with
    ``missing_baseline="zero"``.
    """
    normal_weeks = p.tracked_weeks - F.col("promo_weeks")
    return (
        weeks.groupBy(*SUBCAT_STORE)
        .agg(count_where(F.col("promo_week")).alias("promo_weeks"), _normal_sales().alias("normal"))
        .where(normal_weeks >= p.min_normal_weeks)
        .select(
            *SUBCAT_STORE, "promo_weeks", normal_weeks.alias("normal_weeks"),
            (_filled(F.col("normal"), missing_baseline) / normal_weeks).alias("baseline_weekly"),
        )
    )


def cannibalisation_summary(weeks: DataFrame, p: Params, missing_baseline: str = "null") -> DataFrame:
    """Promoted extra sales against the growth of the whole sub-category, at three levels.

    ``weeks`` is the result of :func:`subcat_weeks` and should be a stored table; its promoted extra sales add
    up to those of all promoted products, measured or not.
    The baseline of a sub-category-store comes from a window over its at most ``tracked_weeks`` rows. The
    range is built from sub-category-store totals because their weeks share one baseline.
    """
    place = Window.partitionBy(*SUBCAT_STORE)
    normal_weeks = p.tracked_weeks - F.col("n_promo")
    measured = (
        weeks.where(F.col("department").isNotNull() & F.col("sub_commodity_desc").isNotNull())
        .withColumns({
            "n_promo": F.count_if("promo_week").over(place),
            "normal": _normal_sales().over(place),
        })
        .where(F.col("promo_week") & (normal_weeks >= p.min_normal_weeks))
        .withColumn("category_extra", F.col("total_sales") - _filled(F.col("normal"), missing_baseline) / normal_weeks)
    )

    def tag(level: str, group):
        return F.struct(F.lit(level).alias("level"), group.alias("grp"))

    tags = F.array(
        tag(CANNIBAL_OVERALL, F.lit(ALL_PROMOTIONS)),
        tag(CANNIBAL_TYPE, F.col("promo_type")),
        tag(CANNIBAL_DEPARTMENT, F.col("department")),
    )
    per_pair = (
        measured.withColumn("tag", F.explode(tags))
        .groupBy("tag.level", "tag.grp", *SUBCAT_STORE)
        .agg(
            F.count(F.lit(1)).alias("weeks"),
            F.sum("promoted_extra").alias("promoted"),
            F.sum("category_extra").alias("category"),
        )
    )
    all_extra = weeks.agg(F.sum("promoted_extra")).scalar()
    own, whole = F.sum("promoted"), F.sum("category")
    summary = per_pair.groupBy("level", "grp").agg(
        F.sum("weeks").alias("subcat_store_weeks"),
        F.count(F.lit(1)).alias("subcat_stores"),
        own.alias("own"),
        whole.alias("whole"),
        clustered_total_ci(F.col("promoted") - F.col("category"), p.z95).alias("ci"),
    )
    taken = F.col("own") - F.col("whole")
    return summary.select(
        "level", "grp", "subcat_store_weeks", "subcat_stores",
        F.round("own", 0).alias("promoted_extra"),
        F.round("whole", 0).alias("category_extra"),
        F.round(taken, 0).alias("taken_from_similar"),
        F.round("ci", 0).alias("taken_ci95"),
        F.round(100 * ratio(taken, F.col("own")), 1).alias("cannibalised_pct"),
        F.when(F.col("level") == CANNIBAL_OVERALL, F.round(100 * ratio(F.col("own"), all_extra), 1)).alias(
            "coverage_pct"),
    )


def cannibalisation_report(summary: DataFrame, p: Params) -> DataFrame:
    """The summary without departments that have too few sub-category-stores."""
    return summary.where(
        (F.col("level") != CANNIBAL_DEPARTMENT) | (F.col("subcat_stores") >= p.min_report_subcat_stores)
    ).orderBy("level", F.desc("promoted_extra"))


def clear_effect():
    """The range around the sales taken does not include zero."""
    return F.abs("taken_from_similar") > F.col("taken_ci95")


def cannibalised_share(summary: DataFrame) -> DataFrame:
    """Share of the extra sales taken from similar products, overall and by promotion type."""
    return summary.where(F.col("level").isin(CANNIBAL_OVERALL, CANNIBAL_TYPE)).select(
        "level", "grp", "promoted_extra", "category_extra", "taken_from_similar", "taken_ci95",
        ratio(F.col("taken_from_similar"), F.col("promoted_extra")).alias("cannibalised_share"),
        ratio(F.col("taken_ci95"), F.abs("promoted_extra")).alias("share_ci95"),
        clear_effect().alias("clear_effect"),
        "coverage_pct",
    )


def cannibalised_by_department(summary: DataFrame, p: Params) -> DataFrame:
    """Larger departments; the percentage is shown only where the effect is clear."""
    return (
        summary.where(
            (F.col("level") == CANNIBAL_DEPARTMENT) & (F.col("subcat_stores") >= p.min_department_subcat_stores)
        )
        .select(
            F.col("grp").alias("department"), "subcat_stores", "promoted_extra", "taken_from_similar", "taken_ci95",
            "cannibalised_pct", F.when(clear_effect(), F.col("cannibalised_pct")).alias("cannibalised_pct_clear"),
        )
        .orderBy(F.desc("promoted_extra"))
    )


def bi_promo_cannibalisation(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("level") == CANNIBAL_TYPE).select(
        F.col("grp").alias("promo_type"), "promoted_extra", "category_extra", "taken_from_similar", "taken_ci95",
        "cannibalised_pct",
    )
