"""The clean layer: merchandise purchases, promotions, weekly sales, trips, households, campaigns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.functions.columns import deal
from shelflift.params import Params
from shelflift.schema import EXCLUDED_DEPARTMENTS, NO_COMMODITY, NOT_PLACED

DISCOUNTS = ("retail_disc", "coupon_disc", "coupon_match_disc")


def _discount() -> Column:
    return reduce(Column.__add__, [F.col(d) for d in DISCOUNTS])


def merchandise(product: DataFrame) -> DataFrame:
    """Products that are goods on a shelf and have a category (a NULL commodity has none)."""
    department = F.trim(F.coalesce("department", F.lit("")))
    return product.where(~department.isin(EXCLUDED_DEPARTMENTS) & (F.col("commodity_desc") != NO_COMMODITY))


def sold_lines(tx: DataFrame) -> DataFrame:
    """Purchase lines where something was sold and paid for, with discounts as positive amounts.

    A positive raw discount is an error and counts as no discount.
    """
    kept = tx.where((F.col("quantity") > 0) & (F.col("sales_value") > 0))
    zero = F.lit(0).cast("decimal(10,2)")
    return kept.withColumns({d: (-F.least(F.col(d), zero)).cast("decimal(10,2)") for d in DISCOUNTS})


def clean_transactions(tx: DataFrame, product: DataFrame) -> DataFrame:
    """One row per product and trip, merchandise only."""
    dims = merchandise(product).select(
        "product_id", "department", "commodity_desc", "sub_commodity_desc", "brand"
    )
    return sold_lines(tx).join(dims, "product_id").select(
        "household_key", "basket_id", "day", "week_no", "trans_time", "store_id", "product_id",
        "department", "commodity_desc", "sub_commodity_desc", "brand",
        "quantity", "sales_value", *DISCOUNTS,
    )


def clean_promotions(causal: DataFrame) -> DataFrame:
    """One row per product, store and week. Codes are any text and compare as text, so any placement wins over '0'.

    The largest text takes a sort. Placements hardly repeat, so they are dealt first and sorted once, in parts, not also in front of the exchange.
    """
    keys = ["product_id", "store_id", "week_no"]
    best = deal(causal.select(*keys, "display", "mailer"), *keys).groupBy(*keys).agg(F.max("display").alias("display"), F.max("mailer").alias("mailer"))
    return best.withColumns({
        "on_display": F.col("display") != NOT_PLACED,
        "in_mailer": F.col("mailer") != NOT_PLACED,
    })


def promo_stores(promotions: DataFrame) -> DataFrame:
    """Stores that have promotion data at all."""
    return promotions.select("store_id").distinct()


def weekly_product_store_sales(
    tx: DataFrame, product: DataFrame, promotions: DataFrame, stores: DataFrame, p: Params
) -> DataFrame:
    """One row per product, store and week with a sale, with the week's promotion flags.

    Purchases are summed on the three keys before anything is joined: the shuffle carries three numbers
    as key instead of category names. They are dealt by these keys once; a distinct count would by itself take an exchange with the
    household and a second one without. What is no merchandise goes before the promotions are joined.
    """
    keys = ["product_id", "store_id", "week_no"]
    lines = sold_lines(tx).where(F.col("product_id").isNotNull()).select(
        *keys, "household_key", "quantity", "sales_value", _discount().alias("discount"))
    weekly = (
        deal(lines, *keys)
        .groupBy(*keys)
        .agg(
            F.sum("quantity").alias("units"),
            F.sum("sales_value").alias("sales"),
            F.sum("discount").alias("discount"),
            F.countDistinct("household_key").alias("households"),
        )
    )
    dims = merchandise(product).select("product_id", "department", "commodity_desc", "sub_commodity_desc")
    tracked_store = stores.select("store_id", F.lit(True).alias("has_promo_data"))
    tracked_week = F.col("week_no").between(p.first_week, p.last_week)
    return (
        weekly.join(dims, "product_id")
        .join(promotions, ["product_id", "store_id", "week_no"], "left")
        .join(tracked_store, "store_id", "left")
        .select(
            "product_id", "store_id", "week_no", "department", "commodity_desc", "sub_commodity_desc",
            "units", "sales", "discount", "households",
            F.coalesce("on_display", F.lit(False)).alias("on_display"),
            F.coalesce("in_mailer", F.lit(False)).alias("in_mailer"),
            "display", "mailer",
            (F.col("has_promo_data").isNotNull() & tracked_week).alias("promo_tracked"),
        )
    )


def weekly_category_sales(lines: DataFrame) -> DataFrame:
    """Sales, trips and households per category and week.

    Two distinct counts in one aggregation would send every line three times. Here lines are dealt by category, week and trip once; sums and trips come
    from there without another exchange, only the households of a category and week take one more. The two small results are put together by group, as names may be NULL.
    """
    keys = ["department", "commodity_desc", "week_no"]
    dealt = deal(lines.select(*keys, "basket_id", "household_key", "sales_value", "quantity", _discount().alias("discount")), *keys, "basket_id")
    per_trip = dealt.groupBy(*keys, "basket_id").agg(
        F.sum("sales_value").alias("sales"), F.sum("quantity").alias("units"), F.sum("discount").alias("discount"))
    sums = per_trip.groupBy(*keys).agg(
        F.sum("sales").cast("decimal(20,2)").alias("sales"),
        F.sum("units").alias("units"),
        F.sum("discount").cast("decimal(22,2)").alias("discount"),
        F.count("basket_id").alias("baskets"),
    )
    homes = dealt.select(*keys, "household_key").distinct().groupBy(*keys).agg(F.count("household_key").alias("households"))
    both = sums.unionByName(homes, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("sales", "units", "discount", "baskets", "households")])


def baskets(lines: DataFrame) -> DataFrame:
    """One row per shopping trip."""
    return lines.groupBy("basket_id", "household_key", "store_id", "day", "week_no").agg(
        F.sum("sales_value").alias("basket_value"),
        F.sum("quantity").alias("items"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(_discount()).alias("discount"),
        F.bool_or(F.col("coupon_disc") > 0).alias("used_coupon"),
    )


def households(trips: DataFrame, targets: DataFrame, redemptions: DataFrame, demographics: DataFrame) -> DataFrame:
    """One row per household: shopping summary, campaigns, coupons, demographics where known."""
    shop = trips.groupBy("household_key").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("trips"),
        F.countDistinct("week_no").alias("active_weeks"),
        F.sum("basket_value").alias("sales"),
        F.sum("discount").alias("discount"),
    ).withColumn("avg_basket", F.col("sales").cast("double") / F.col("trips"))
    received = targets.groupBy("household_key").agg(F.count(F.lit(1)).alias("campaigns_received"))
    redeemed = redemptions.groupBy("household_key").agg(F.count(F.lit(1)).alias("coupons_redeemed"))
    known = demographics.withColumn("has_demographics", F.lit(True))
    return (
        shop.join(received, "household_key", "left")
        .join(redeemed, "household_key", "left")
        .join(known, "household_key", "left")
        .select(
            "household_key", "first_day", "last_day", "trips", "active_weeks", "sales", "avg_basket", "discount",
            F.coalesce("campaigns_received", F.lit(0)).alias("campaigns_received"),
            F.coalesce("coupons_redeemed", F.lit(0)).alias("coupons_redeemed"),
            F.coalesce("has_demographics", F.lit(False)).alias("has_demographics"),
            "age_desc", "income_desc", "marital_status_code", "homeowner_desc",
            "hh_comp_desc", "household_size_desc", "kid_category_desc",
        )
    )


def clean_coupons(coupon: DataFrame) -> DataFrame:
    return coupon.dropDuplicates(["coupon_upc", "product_id", "campaign"])


def campaigns(campaign_desc: DataFrame, targets: DataFrame) -> DataFrame:
    """Campaigns with their length and the number of households targeted (0 when none)."""
    reach = targets.groupBy("campaign").agg(F.count("household_key").alias("households_targeted"))
    return campaign_desc.join(reach, "campaign", "left").select(
        "campaign",
        F.col("description").alias("campaign_type"),
        "start_day",
        "end_day",
        (F.col("end_day") - F.col("start_day") + 1).alias("length_days"),
        F.coalesce("households_targeted", F.lit(0)).alias("households_targeted"),
    )


def clean_reconciliation(
    tx: DataFrame, lines: DataFrame, trips: DataFrame, causal: DataFrame, promotions: DataFrame,
    stores: DataFrame, raw_coupons: DataFrame, coupons: DataFrame,
) -> DataFrame:
    """What cleaning removed: rows, sales, baskets and households before and after."""
    def purchases(df: DataFrame, layer: str, amount: str) -> DataFrame:
        # Several distinct counts multiply their input rows, so lines are summed per trip first.
        per_trip = df.groupBy("basket_id", "household_key").agg(
            F.count(F.lit(1)).alias("n"), F.sum(amount).alias("amount"))
        return per_trip.agg(
            F.sum("n").alias("rows"),
            F.round(F.sum("amount"), 0).cast("double").alias("sales"),
            F.countDistinct("basket_id").alias("baskets"),
            F.countDistinct("household_key").alias("households"),
        ).select(F.lit(layer).alias("layer"), "*")

    def sizes(layer: str, raw: DataFrame, kept: DataFrame, groups: DataFrame | None = None) -> DataFrame:
        n = F.count(F.lit(1))
        third = groups.agg(n).scalar() if groups is not None else F.lit(None).cast("bigint")
        return raw.agg(n.alias("rows")).select(
            F.lit(layer).alias("layer"), "rows", F.lit(None).cast("double").alias("sales"),
            kept.agg(n).scalar().alias("baskets"), third.alias("households"),
        )

    # The layer names are fixed values.
    parts = [
        purchases(tx, "1. raw transactions", "sales_value"),
        purchases(lines, "2. clean transactions", "sales_value"),
        purchases(trips, "3. clean baskets (rows should = baskets)", "basket_value"),
        sizes("4. promotions: raw rows / clean rows / stores", causal, promotions, stores),
        sizes("5. coupons: raw rows / clean rows", raw_coupons, coupons),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("layer")
