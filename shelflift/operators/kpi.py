"""The KPI trees: where sales come from, and what promotions really added."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelflift.functions.columns import pct_change, ratio
from shelflift.functions.ranking import exact_quantiles
from shelflift.schema import CANNIBAL_TYPE, LEVEL_TYPE


def kpi_sales_tree(tx: DataFrame) -> DataFrame:
    """Sales = households x trips per household x spend per trip, with the covered range.

    Several distinct counts multiply their input rows, so purchases are summed per trip first.
    """
    per_trip = tx.groupBy("basket_id", "household_key", "store_id").agg(
        F.sum("sales_value").alias("sales"),
        *[fn(c).alias(f"{name}_{c}") for c in ("day", "week_no") for name, fn in (("min", F.min), ("max", F.max))],
    )
    return per_trip.agg(
        F.sum("sales").cast("double").alias("sales"),
        F.countDistinct("household_key").alias("households"),
        F.countDistinct("basket_id").alias("trips"),
        F.countDistinct("store_id").alias("stores"),
        F.min("min_day").alias("first_day"),
        F.max("max_day").alias("last_day"),
        F.min("min_week_no").alias("first_week"),
        F.max("max_week_no").alias("last_week"),
    ).withColumns({
        "trips_per_household": ratio(F.col("trips"), F.col("households")),
        "spend_per_trip": ratio(F.col("sales"), F.col("trips")),
    })


def kpi_rebuild_check(tree: DataFrame) -> DataFrame:
    rebuilt = F.col("households") * F.col("trips_per_household") * F.col("spend_per_trip")
    return tree.select("sales", rebuilt.alias("rebuilt")).withColumn(
        "matches", F.round("sales", 0) == F.round("rebuilt", 0)
    )


def kpi_discounts(tx: DataFrame) -> DataFrame:
    """Discount amounts, their share of sales and the share of lines with any."""
    any_discount = (F.col("retail_disc") != 0) | (F.col("coupon_disc") != 0)
    return tx.agg(
        F.sum(F.abs("retail_disc")).cast("double").alias("retail_discount"),
        F.sum(F.abs("coupon_disc")).cast("double").alias("coupon_discount"),
        F.sum("sales_value").cast("double").alias("sales"),
        ratio(F.count_if(any_discount), F.count(F.lit(1))).alias("discounted_lines"),
    ).select(
        "retail_discount", "coupon_discount",
        ratio(F.col("retail_discount") + F.col("coupon_discount"), F.col("sales")).alias("discount_share"),
        "discounted_lines",
    )


DISCOUNT_COLUMNS = ("retail_disc", "coupon_disc")


def discount_counts(tx: DataFrame, columns=DISCOUNT_COLUMNS) -> DataFrame:
    """(column_name, v, c): how many purchase lines have each discount, from one pass over the lines."""
    together = tx.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in columns]))
    return together.select(each.alias("e"), "n").groupBy("e.column_name", "e.v").agg(F.sum("n").alias("c"))


def kpi_discount_describe(counts: DataFrame) -> DataFrame:
    """Count, mean, spread, quartiles and range of the discount columns, one row each, from :func:`discount_counts`."""
    v, c = F.col("v"), F.col("c")
    sums = counts.where("v IS NOT NULL").groupBy("column_name").agg(
        F.sum("c").alias("count"), F.sum((v * c).cast("decimal(38,2)")).cast("double").alias("s1"),
        F.sum((v * v * c).cast("decimal(38,4)")).cast("double").alias("s2"),
        F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"))
    n = F.col("count")
    basics = sums.withColumn("mean", ratio(F.col("s1"), n)).withColumn(
        "std", F.sqrt(F.greatest(ratio(F.col("s2") - F.col("s1") * F.col("mean"), n - 1), F.lit(0.0))))
    return basics.join(exact_quantiles(counts, [0.25, 0.5, 0.75], "column_name"), "column_name").select(
        "column_name", "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")


def kpi_campaign_reach(
    tx: DataFrame, campaign_desc: DataFrame, targets: DataFrame, demographics: DataFrame
) -> DataFrame:
    """Campaigns per type, and the households reached and described."""
    shoppers = tx.agg(F.countDistinct("household_key")).scalar()
    reached = targets.agg(F.countDistinct("household_key")).scalar()
    described = demographics.agg(F.countDistinct("household_key")).scalar()
    return (
        campaign_desc.groupBy("description")
        .agg(F.count(F.lit(1)).alias("campaigns"))
        .withColumns({"households": shoppers, "households_reached": reached, "households_described": described})
        .withColumn("reach", ratio(F.col("households_reached"), F.col("households")))
    )


def kpi_items_per_trip(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.count(F.lit(1)).alias("purchase_lines"),
        F.countDistinct("basket_id").alias("trips"),
        F.sum("sales_value").cast("double").alias("sales"),
    ).select(
        "purchase_lines", "trips",
        ratio(F.col("purchase_lines"), F.col("trips")).alias("items_per_trip"),
        ratio(F.col("sales"), F.col("purchase_lines")).alias("spend_per_item"),
    )


def _weekly_sales(trips: DataFrame) -> DataFrame:
    return trips.groupBy("week_no").agg(F.sum("basket_value").cast("double").alias("sales"))


def kpi_rolling_4w(trips: DataFrame) -> DataFrame:
    """Sales of the last four weeks, week by week.

    Each week's sales are added to the week itself and the three after it, so no window over all weeks.
    """
    weekly = _weekly_sales(trips)
    spread = weekly.select(F.explode(F.sequence(F.col("week_no"), F.col("week_no") + 3)).alias("week_no"),
                           F.col("sales").alias("part"))
    rolling = spread.groupBy("week_no").agg(F.sum("part").alias("rolling_4w_sales"))
    return weekly.join(rolling, "week_no")


def kpi_wow(trips: DataFrame) -> DataFrame:
    """Week-on-week change; NULL when the week before has no sales."""
    weekly = _weekly_sales(trips)
    before = weekly.select((F.col("week_no") + 1).alias("week_no"), F.col("sales").alias("last_week"))
    return weekly.join(before, "week_no", "left").withColumn(
        "change", pct_change(F.col("sales"), F.col("last_week"))
    )


def kpi_net_extra(uplift: DataFrame, cannibalisation: DataFrame) -> DataFrame:
    """Extra sales after pull-forward and cannibalisation, per promotion type."""
    gross = uplift.where(F.col("level") == LEVEL_TYPE).select(
        F.col("placement").alias("promo_type"), "extra_sales",
        F.coalesce("after_promo_change", F.lit(0.0)).alias("after_promo_change"), "discount_given",
    )
    taken = cannibalisation.where(F.col("level") == CANNIBAL_TYPE).select(
        F.col("grp").alias("promo_type"), "taken_from_similar"
    )
    net = F.col("extra_sales") + F.col("after_promo_change") - F.coalesce("taken_from_similar", F.lit(0.0))
    return gross.join(taken, "promo_type", "left").withColumn("net_extra", net).withColumn(
        "net_extra_per_discount_dollar", ratio(F.col("net_extra"), F.col("discount_given"))
    )


