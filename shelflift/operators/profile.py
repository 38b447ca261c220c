"""First look at the raw tables: sizes, keys, ranges, coverage and how well they join."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Tables = Mapping[str, DataFrame]

# (check, table, key columns). The check names are fixed values, here and below.
KEYS = [
    ("1. product: distinct product_id of rows", "product", ["product_id"]),
    ("2. hh_demographic: distinct household_key of rows", "hh_demographic", ["household_key"]),
    ("3. campaign_desc: distinct campaign of rows", "campaign_desc", ["campaign"]),
    ("4. campaign_table: distinct (household, campaign) of rows", "campaign_table", ["household_key", "campaign"]),
    ("5. coupon: distinct (coupon_upc, product_id, campaign) of rows", "coupon", ["coupon_upc", "product_id", "campaign"]),
    ("6. transactions: distinct (basket, product) of rows", "transaction_data", ["basket_id", "product_id"]),
    ("7. causal_data: distinct (product, store, week) of rows", "causal_data", ["product_id", "store_id", "week_no"]),
]


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _rows(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def profile_row_counts(tables: Tables) -> DataFrame:
    """Rows per table, largest first."""
    return _rows([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]).orderBy(F.desc("row_count"), "table_name")


def profile_key_uniqueness(tables: Tables) -> DataFrame:
    """Distinct keys out of rows. Composite keys are counted as one value, so rows with NULLs count."""
    frames = []
    for check, table, cols in KEYS:
        key = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
        frames.append(
            tables[table]
            .agg(F.countDistinct(key).alias("d"), F.count(F.lit(1)).alias("n"))
            .select(F.lit(check).alias("check_name"), _text(F.col("d"), " of ", F.col("n")).alias("result"))
        )
    return _rows(frames)


def profile_ranges(tables: Tables) -> DataFrame:
    """Day and week ranges, and the first and last campaign day."""
    tx = tables["transaction_data"].agg(
        _text(F.min("day"), "-", F.max("day"), " / ", F.min("week_no"), "-", F.max("week_no")).alias("result")
    )
    causal = tables["causal_data"].agg(_text(F.min("week_no"), "-", F.max("week_no")).alias("result"))
    campaigns = tables["campaign_desc"].agg(_text(F.min("start_day"), " / ", F.max("end_day")).alias("result"))
    named = [("8. transactions: day range / week range", tx), ("9. causal_data: week range", causal), ("10. campaigns: first start day / last end day", campaigns)]
    return _rows([df.select(F.lit(name).alias("check_name"), "result") for name, df in named])


def profile_coverage(tables: Tables) -> DataFrame:
    """Distinct stores and households per table that holds them.

    Two distinct counts would multiply the purchases, so those are reduced to (store, household) first.
    """
    def distinct(table: str, column: str) -> Column:
        return tables[table].agg(F.countDistinct(column)).scalar()

    stores = _text(distinct("causal_data", "store_id"), " / ", F.col("stores"))
    homes = _text(
        F.col("households"), " / ", distinct("hh_demographic", "household_key"),
        " / ", distinct("campaign_table", "household_key"),
    )
    tx = tables["transaction_data"].select("store_id", "household_key").distinct().agg(
        F.countDistinct("store_id").alias("stores"), F.countDistinct("household_key").alias("households")
    )
    return tx.select(F.explode(F.array(
        F.struct(F.lit("11. stores: in causal_data / in transactions").alias("check_name"), stores.alias("result")),
        F.struct(F.lit("12. households: transactions / demographics / campaigns").alias("check_name"), homes.alias("result")),
    )).alias("r")).select("r.*")


def _orphans(facts: DataFrame, dim: DataFrame, key: str, check: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension; facts are counted per key before the join."""
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = per_key.join(dim.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).select(
        F.lit(check).alias("check_name"), "row_count"
    )


def profile_orphan_products(tables: Tables) -> DataFrame:
    return _orphans(tables["transaction_data"], tables["product"], "product_id", "13. transaction rows whose product_id is missing from product")


def profile_orphan_coupons(tables: Tables) -> DataFrame:
    return _orphans(tables["coupon_redempt"], tables["coupon"], "coupon_upc", "14. redemptions whose coupon_upc is missing from coupon")
