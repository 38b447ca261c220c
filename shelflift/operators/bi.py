"""Small tidy tables for dashboards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.params import Params
from shelflift.schema import INCOME_BANDS, NOT_KNOWN, TOP_INCOME_BAND


def dim_week(trips: DataFrame, p: Params) -> DataFrame:
    """One row per week with its year, quarter and whether every day has data."""
    week, days = F.col("week_no"), F.col("days_with_data")
    return trips.groupBy("week_no").agg(F.countDistinct("day").alias("days_with_data")).select(
        "week_no",
        F.when(week <= 52, 1).otherwise(2).alias("year_no"),
        ((week - 1) % 52 + 1).alias("week_of_year"),
        F.concat(F.lit("Q"), (F.floor((week - 1) / 13) + 1).cast("string")).alias("quarter_label"),
        "days_with_data",
        (days >= p.complete_week_days).alias("complete_week"),
    )


def fact_baskets(trips: DataFrame) -> DataFrame:
    return trips.select(
        "basket_id", "household_key", "store_id", "day", "week_no", "basket_value", "items", "lines", "discount",
        "used_coupon",
    )


def fact_category_week(weekly_category: DataFrame) -> DataFrame:
    return weekly_category.select(
        "department", "commodity_desc", "week_no", "sales", "units", "discount", "baskets", "households"
    )


def dashboard_income_band(income: Column) -> Column:
    """Like the analysis bands, but any other known income counts as the top band."""
    by_band: dict[str, list[str]] = {}
    for raw, band in INCOME_BANDS.items():
        by_band.setdefault(band, []).append(raw)
    bands = [F.when(income.isin(raws), band) for band, raws in by_band.items() if band != TOP_INCOME_BAND]
    return F.coalesce(*bands, F.when(income.isNotNull(), TOP_INCOME_BAND), F.lit(NOT_KNOWN))


def dim_household(rfm: DataFrame, homes: DataFrame) -> DataFrame:
    """One row per household: segment, churn flags, campaigns, coupons and demographics."""
    about = homes.select(
        "household_key", "campaigns_received", "coupons_redeemed", "has_demographics", "age_desc", "income_desc",
        "hh_comp_desc", "homeowner_desc",
    )

    def known(name: str) -> Column:
        return F.coalesce(name, F.lit(NOT_KNOWN)).alias(name)

    return rfm.join(about, "household_key").select(
        "household_key", "segment", "r_score", "f_score", "m_score", "days_since_last", "trips", "sales",
        "gone_quiet", "fading", (F.col("gone_quiet") | F.col("fading")).alias("churn_risk"),
        "last_13w_sales", "prev_13w_sales", "campaigns_received", "coupons_redeemed",
        (F.col("campaigns_received") > 0).alias("targeted"),
        (F.col("coupons_redeemed") > 0).alias("redeemed"),
        "has_demographics", known("age_desc"),
        dashboard_income_band(F.col("income_desc")).alias("income_band"),
        known("hh_comp_desc"), known("homeowner_desc"),
    )


def bi_row_counts(views: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("view_name"), "rows")
        for name, df in views.items()
    ]
    return reduce(DataFrame.unionByName, counts)
