"""Fourteen quality checks on the raw tables and two drill-downs.

All checks on one table are conditional counts in a single pass, so a report reads each table once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.functions.columns import count_where, deal
from shelflift.schema import NO_COMMODITY

Tables = Mapping[str, DataFrame]


def _slashed(*counts: Column) -> Column:
    return F.concat_ws(" / ", *[c.cast("string") for c in counts])


def _blank(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit(""))) == ""


def _any_null(*names: str) -> Column:
    return reduce(Column.__or__, [F.col(n).isNull() for n in names])


def _extra_rows(*key: str) -> Column:
    """Rows beyond the first of each key; the struct makes rows with NULLs count."""
    return F.count(F.lit(1)) - F.countDistinct(F.struct(*key))


# The names that the checks report.
NAMES = {
    "dq_null_keys": "A1. transactions: rows with a NULL in any key column",
    "dq_blank_category": "A2. product: rows with a blank or NULL department / commodity",
    "dq_placeholder_category": "A3. product: rows labelled NO COMMODITY DESCRIPTION",
    "dq_dup_coupon": "B1. coupon: exact duplicate rows",
    "dq_dup_redempt": "B2. coupon_redempt: exact duplicate rows",
    "dq_sales_sign": "C1. transactions: sales_value = 0 / sales_value < 0",
    "dq_quantity_sign": "C2. transactions: quantity = 0 / quantity < 0",
    "dq_positive_discounts": "C3. transactions: positive retail_disc / coupon_disc / coupon_match_disc",
    "dq_quantity_outlier": "D1. transactions: quantity > 100 (rows) / max quantity",
    "dq_sales_outlier": "D2. transactions: sales_value > 100 (rows) / max sales_value",
    "dq_week_span": "E1. weeks whose days span more than 7 days",
    "dq_bad_time": "E2. transactions: trans_time not a real HHMM time",
    "dq_redempt_outside": "E3. redemptions outside their campaign's start-end days",
    "dq_campaign_order": "E4. campaigns where end_day is before start_day",
}
CHECKS = list(NAMES)
PURCHASES = "transaction_data"


def _purchase_tallies() -> dict[str, list[Column]]:
    """What each check on purchases counts or takes the maximum of, per week."""
    c = F.col
    return {
        "dq_null_keys": [count_where(_any_null("household_key", "basket_id", "product_id", "store_id", "day", "week_no", "sales_value"))],
        "dq_sales_sign": [count_where(c("sales_value") == 0), count_where(c("sales_value") < 0)],
        "dq_quantity_sign": [count_where(c("quantity") == 0), count_where(c("quantity") < 0)],
        "dq_positive_discounts": [count_where(c(d) > 0) for d in ("retail_disc", "coupon_disc", "coupon_match_disc")],
        "dq_quantity_outlier": [count_where(c("quantity") > 100), F.max("quantity")],
        "dq_sales_outlier": [count_where(c("sales_value") > 100), F.max("sales_value")],
        "dq_week_span": [F.max("day") - F.min("day")],
        "dq_bad_time": [count_where((c("trans_time") < 0) | (c("trans_time") > 2359) | (c("trans_time") % 100 > 59))],
    }


def _purchase_report(tx: DataFrame, checks: list[str]) -> DataFrame:
    """One row with a column per check: one pass over the purchases, by week, whose spans a check needs; then over the weeks."""
    tallies = _purchase_tallies()
    per_week = tx.groupBy("week_no").agg(*[
        t.alias(f"{check}_{i}") for check in checks for i, t in enumerate(tallies[check])])

    def over_weeks(check: str) -> Column:
        parts = [F.col(f"{check}_{i}") for i in range(len(tallies[check]))]
        if check == "dq_week_span":
            return count_where(parts[0] > 6).cast("string")
        if check.endswith("_outlier"):
            return _slashed(F.coalesce(F.sum(parts[0]), F.lit(0)), F.max(parts[1]))
        return _slashed(*[F.coalesce(F.sum(x), F.lit(0)) for x in parts])

    return per_week.agg(*[over_weeks(check).alias(check) for check in checks])


def _rules() -> dict[str, tuple[str, Column]]:
    c = F.col
    return {
        "dq_blank_category": ("product", count_where(_blank("department") | _blank("commodity_desc"))),
        "dq_placeholder_category": ("product", count_where(c("commodity_desc") == NO_COMMODITY)),
        "dq_dup_coupon": ("coupon", _extra_rows("coupon_upc", "product_id", "campaign")),
        "dq_dup_redempt": ("coupon_redempt", _extra_rows("household_key", "day", "coupon_upc", "campaign")),
        "dq_redempt_outside": ("redemption", count_where((c("day") < c("start_day")) | (c("day") > c("end_day")))),
        "dq_campaign_order": ("campaign_desc", count_where(c("end_day") < c("start_day"))),
    }


def _input(tables: Tables, name: str) -> DataFrame:
    if name == "redemption":
        return tables["coupon_redempt"].join(
            tables["campaign_desc"].select("campaign", "start_day", "end_day"), "campaign"
        )
    return tables[name]


def dq_report(tables: Tables, checks: Iterable[str] = tuple(CHECKS)) -> DataFrame:
    """``(check_name, result)`` for the wanted checks, in order; one pass over each input table."""
    rules = _rules()
    by_input: dict[str, list[str]] = {}
    for check in checks:
        by_input.setdefault(rules[check][0] if check in rules else PURCHASES, []).append(check)
    frames = []
    for source, names in by_input.items():
        counted = _purchase_report(tables[PURCHASES], names) if source == PURCHASES else _input(tables, source).agg(
            *[rules[n][1].cast("string").alias(n) for n in names])
        pairs = F.array(*[F.struct(F.lit(NAMES[n]).alias("check_name"), F.col(n).alias("result")) for n in names])
        frames.append(counted.select(F.explode(pairs).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, frames).orderBy("check_name")


def dq_causal_conflicts(causal: DataFrame) -> DataFrame:
    """Repeated placement keys: how many are exact copies and how many disagree. One exchange, by the key, serves both counts."""
    key = ["product_id", "store_id", "week_no"]
    versions = deal(causal.select(*key, "display", "mailer"), *key).groupBy(*key, "display", "mailer").agg(
        F.count(F.lit(1)).alias("copies")
    )
    keys = versions.groupBy(*key).agg(
        F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("versions")
    )
    repeated, conflicting = F.col("rows") > 1, F.col("versions") > 1
    return keys.agg(
        count_where(repeated).alias("keys_with_repeats"),
        count_where(repeated & ~conflicting).alias("exact_copies"),
        count_where(conflicting).alias("conflicting_placements"),
    )


def dq_department_sales(tx: DataFrame, product: DataFrame) -> DataFrame:
    """Sales and oddities per department. Purchases are summed per product before the join."""
    per_product = tx.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("sales_value").alias("sales"),
        F.max("quantity").alias("max_quantity"),
        count_where(F.col("sales_value") <= 0).alias("zero_or_neg_sales_rows"),
        count_where(F.col("retail_disc") > 0).alias("positive_disc_rows"),
    )
    return (
        per_product.join(product.select("product_id", "department"), "product_id")
        .groupBy("department")
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.sum("rows").alias("rows"),
            F.round(F.sum("sales"), 0).cast("double").alias("sales"),
            F.max("max_quantity").alias("max_quantity"),
            F.sum("zero_or_neg_sales_rows").alias("zero_or_neg_sales_rows"),
            F.sum("positive_disc_rows").alias("positive_disc_rows"),
        )
        .orderBy(F.desc("sales"))
    )
