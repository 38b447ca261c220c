"""Sizing of the recommendations, from the measured uplift, cannibalisation and segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.functions.columns import constant_rows, ratio
from shelflift.operators.cannibal import clear_effect
from shelflift.params import Params
from shelflift.schema import (
    AT_RISK, BOTH, CANNIBAL_DEPARTMENT, CANNIBAL_TYPE, CHAMPIONS, DISPLAY_ONLY, LEVEL_MAILER, LEVEL_TYPE,
    MAILER_ONLY,
)


def _kept(pct: Column) -> Column:
    """Share of extra sales that is not taken from similar products; a halo earns no credit."""
    return 1 - F.when(pct.isNotNull(), F.least(F.greatest(pct, F.lit(0.0)), F.lit(100.0))) / 100


def promo_type_economics(uplift: DataFrame, cannibalisation: DataFrame) -> DataFrame:
    """Discount and net extra sales per promoted week, by promotion type."""
    pct = cannibalisation.where(F.col("level") == CANNIBAL_TYPE).select(
        F.col("grp").alias("placement"), "cannibalised_pct"
    )
    return (
        uplift.where(F.col("level") == LEVEL_TYPE)
        .join(pct, "placement", "left")
        .select(
            "placement", "promo_weeks", "avg_extra_per_week",
            ratio(F.col("discount_given"), F.col("promo_weeks")).alias("discount_per_week"),
            "cannibalised_pct",
            (F.col("avg_extra_per_week") * _kept(F.col("cannibalised_pct"))).alias("net_extra_per_week"),
        )
    )


def _per_1000_households(amount: Column, households: Column, p: Params) -> Column:
    return ratio(amount / p.years, households) * 1000


def rec_display_on_mailer(economics: DataFrame, homes: DataFrame, p: Params) -> DataFrame:
    """What it brings to give a share of mailer-only weeks a display as well."""
    def of(kind: str, column: str) -> Column:
        return F.max(F.when(F.col("placement") == kind, F.col(column)))

    one = economics.agg(
        (of(BOTH, "net_extra_per_week") - of(MAILER_ONLY, "net_extra_per_week")).alias("gain"),
        (of(BOTH, "discount_per_week") - of(MAILER_ONLY, "discount_per_week")).alias("cost"),
        of(MAILER_ONLY, "promo_weeks").alias("mailer_weeks"),
        (of(DISPLAY_ONLY, "promo_weeks") + of(BOTH, "promo_weeks")).alias("display_weeks"),
    )
    households = homes.agg(F.count(F.lit(1))).scalar()
    weeks = F.round(F.col("share_of_mailer_weeks") * F.col("mailer_weeks"), 0)
    return (
        constant_rows(one, "share_of_mailer_weeks", p.scenarios)
        .withColumn("weeks_converted", weeks)
        .select(
            "share_of_mailer_weeks", "weeks_converted",
            F.col("gain").alias("gain_per_week"), F.col("cost").alias("discount_per_week"),
            (F.col("weeks_converted") * F.col("gain")).alias("extra_sales"),
            (F.col("weeks_converted") * F.col("cost")).alias("extra_discount"),
            ratio(F.col("weeks_converted"), F.col("display_weeks")).alias("more_display_weeks"),
        )
        .withColumn("extra_sales_per_discount_dollar", ratio(F.col("extra_sales"), F.col("extra_discount")))
        .withColumn("extra_sales_per_1000_hh_yr", _per_1000_households(F.col("extra_sales"), households, p))
    )


def rec_slot_upgrade(uplift: DataFrame) -> DataFrame:
    """Moving one interior-page slot to the front page."""
    mail = uplift.where(F.col("level") == LEVEL_MAILER).withColumn(
        "discount_per_week", ratio(F.col("discount_given"), F.col("promo_weeks"))
    )

    def step(column: str) -> Column:
        front, interior = (F.max(F.when(F.col("placement") == code, F.col(column))) for code in ("D", "A"))
        return front - interior

    return mail.agg(
        step("avg_extra_per_week").alias("extra_sales_per_week"),
        step("discount_per_week").alias("extra_discount_per_week"),
    ).withColumn("sales_per_discount_dollar", ratio(F.col("extra_sales_per_week"), F.col("extra_discount_per_week")))


def rec_cut_departments(uplift_weeks: DataFrame, cannibalisation: DataFrame, p: Params) -> DataFrame:
    """Departments where promotions clearly shift much of their sales from similar products."""
    own = uplift_weeks.groupBy("department").agg(
        F.count(F.lit(1)).alias("promo_weeks"),
        F.sum("incremental_sales").alias("extra_sales"),
        F.sum("discount").cast("double").alias("discount_given"),
    )
    measured = cannibalisation.where(
        (F.col("level") == CANNIBAL_DEPARTMENT)
        & (F.col("subcat_stores") >= p.min_department_subcat_stores)
        & clear_effect()
        & (F.col("promoted_extra") > 0)
        & (F.col("cannibalised_pct") >= p.min_cannibalised_pct)
    ).select(F.col("grp").alias("department"), "promoted_extra", "taken_from_similar", "taken_ci95", "cannibalised_pct")
    return (
        own.join(measured, "department")
        .withColumn("net_extra", F.col("extra_sales") * _kept(F.col("cannibalised_pct")))
        .withColumn("net_extra_per_discount_dollar", ratio(F.col("net_extra"), F.col("discount_given")))
    )


def avg_coupon_value(lines: DataFrame) -> DataFrame:
    """Average coupon plus match discount on lines with a coupon."""
    value = F.col("coupon_disc") + F.col("coupon_match_disc")
    return lines.where(F.col("coupon_disc") > 0).agg(
        F.count(F.lit(1)).alias("coupon_lines"), ratio(F.sum(value), F.count(F.lit(1))).alias("avg_coupon")
    )


def rec_at_risk_value(dim: DataFrame, coupon: DataFrame, p: Params) -> DataFrame:
    """Yearly sales at stake among at-risk households against the coupons Champions redeem today."""
    at_risk = F.col("segment") == AT_RISK
    p_leave = F.when(F.col("churn_risk"), p.churn_if_flagged).otherwise(p.churn_if_not)
    zero = F.lit(0.0)
    one = dim.agg(
        F.count(F.lit(1)).alias("households"),
        F.count_if(at_risk).alias("at_risk_households"),
        F.coalesce(F.sum(F.when(at_risk, F.col("sales").cast("double") / p.years)), zero).alias("at_risk_sales_per_year"),
        F.coalesce(F.sum(F.when(at_risk, F.col("sales").cast("double") / p.years * p_leave)), zero).alias("at_stake"),
        F.coalesce(F.sum(F.when(F.col("segment") == CHAMPIONS, F.col("coupons_redeemed"))), F.lit(0)).alias("coupons"),
    )
    avg_coupon = coupon.select("avg_coupon").scalar()
    cost = F.col("coupons") * avg_coupon / p.years
    return (
        constant_rows(one.withColumn("coupon_cost_per_year", cost), "share_of_leavers_saved", p.scenarios)
        .withColumn("sales_kept_per_year", F.col("share_of_leavers_saved") * F.col("at_stake"))
        .select(
            "share_of_leavers_saved", "at_risk_households", "at_risk_sales_per_year",
            F.col("at_stake").alias("sales_at_stake_per_year"), "coupon_cost_per_year",
            ratio(F.col("coupon_cost_per_year"), F.col("at_stake")).alias("break_even_share"),
            "sales_kept_per_year",
            (ratio(F.col("sales_kept_per_year"), F.col("households")) * 1000).alias("sales_kept_per_1000_hh_yr"),
        )
    )


def rec_summary(
    display: DataFrame, cuts: DataFrame, at_risk: DataFrame, homes: DataFrame, p: Params
) -> DataFrame:
    """The three sized recommendations per year and per 1,000 households, middle scenario."""
    middle = p.scenarios[len(p.scenarios) // 2]
    zero = F.lit(0.0)
    parts = [
        display.where(F.col("share_of_mailer_weeks") == middle).select(
            F.lit("1. display on mailer items").alias("recommendation"),
            (F.col("extra_sales") / p.years).alias("extra_sales_per_year"),
            (F.col("extra_discount") / p.years).alias("extra_discount_per_year"),
        ),
        cuts.agg(
            (-F.coalesce(F.sum("net_extra"), zero) / p.years).alias("extra_sales_per_year"),
            (-F.coalesce(F.sum("discount_given"), zero) / p.years).alias("extra_discount_per_year"),
        ).select(F.lit("2. cut cannibalising promotions").alias("recommendation"), "*"),
        at_risk.where(F.col("share_of_leavers_saved") == middle).select(
            F.lit("3. coupons to at-risk households").alias("recommendation"),
            F.col("sales_kept_per_year").alias("extra_sales_per_year"),
            zero.alias("extra_discount_per_year"),
        ),
    ]
    households = homes.agg(F.count(F.lit(1))).scalar()
    return reduce(DataFrame.unionByName, parts).withColumns({
        "extra_sales_per_1000_hh_yr": ratio(F.col("extra_sales_per_year"), households) * 1000,
        "discount_change_per_1000_hh_yr": ratio(F.col("extra_discount_per_year"), households) * 1000,
    })
