"""Weekly refresh: tables whose rows belong to one week each are stored by week, and only weeks that changed are built and written again.

Each table's week is a folder of its own; the published set names, for every table and week, the version that wrote it last. A refresh reads the purchases
and placements of the changed weeks alone, writes their folders into a new version and publishes old and new folders together, all at once.

One thing reaches beyond its week: a store counts as tracked if it has placements in any week. Where a refresh gives a store its first placements, or
takes its last ones, the weeks in which that store sold are built again too. A changed product table asks for a refresh of all weeks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelflift.operators import clean
from shelflift.params import Params
from shelflift.sources.published import Publication

WEEK, NO_WEEK = "week_no", "__HIVE_DEFAULT_PARTITION__"
# Per table, the columns after the week by whose hash it is dealt into files, each sorted by them; together they tell the rows of a large week apart.
CUT_BY = {
    "transactions": ("basket_id", "product_id"),
    "promotions": ("product_id", "store_id"),
    "promo_store_weeks": ("store_id",),
    "weekly_product_store_sales": ("product_id", "store_id"),
    "weekly_category_sales": ("department", "commodity_desc"),
    "baskets": ("basket_id", "household_key"),
}


def _publication(spark: SparkSession, out: str) -> Publication:
    return Publication(spark, f"{out.rstrip('/')}/weekly")


def _in(weeks: Iterable[int | None]) -> Column:
    known = [w for w in weeks if w is not None]
    return F.col(WEEK).isin(known) | (F.col(WEEK).isNull() if None in weeks else F.lit(False))


def _folder(week: int | None) -> str:
    return f"week={NO_WEEK if week is None else week}"


def _read(spark: SparkSession, paths: Mapping[str, str], table: str) -> DataFrame:
    return spark.read.parquet(*[path for name, path in paths.items() if name.startswith(f"{table}/")])


def week_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the newest published refresh, all weeks; empty before the first."""
    paths = _publication(spark, out).current()
    return {table: _read(spark, paths, table) for table in CUT_BY} if paths else {}


def refresh_weeks(
    spark: SparkSession, raw: Mapping[str, DataFrame], out: str, weeks: Iterable[int | None] | None = None, params: Params = Params()
) -> dict[str, DataFrame]:
    """Build ``weeks`` (default: all; None among them: rows without a week) again from ``raw``, publish them under ``<out>/weekly``, and return the tables.

    A week that ``raw`` does not hold any more goes. A run that fails leaves the set published before.
    """
    published = _publication(spark, out)
    before, version = published.current(), published.begin()
    weeks = None if weeks is None or not before else set(weeks)
    after = {} if weeks is None else {name: path for name, path in before.items() if name.split("/")[1] not in {_folder(w) for w in weeks}}

    def changed(name: str, which: set | None) -> DataFrame:
        return raw[name] if which is None else raw[name].where(_in(which))

    def store(table: str, df: DataFrame, among: set | None = weeks, part: str = "") -> None:
        path = f"{version}/{table}{part}"
        # Dealt by week and part, not by range: a range exchange samples its input first, which computes the table twice. A week has so many parts
        # that all tasks have work, also where one week is refreshed.
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = -(-tasks // max(1, params.last_week + 1 if among is None else len(among)))
        rows = df.repartition(tasks, WEEK, F.pmod(F.hash(*CUT_BY[table]), F.lit(parts))).sortWithinPartitions(WEEK, *CUT_BY[table])
        rows.withColumn("week", F.col(WEEK)).write.partitionBy("week").parquet(path)
        spark.createDataFrame([], df.schema).write.parquet(f"{path}-schema")
        after[f"{table}/schema"] = f"{path}-schema"
        after.update({f"{table}/{folder}": f"{path}/{folder}" for folder in published.folders(path) if folder.startswith("week=")})

    store("transactions", clean.clean_transactions(changed("transaction_data", weeks), raw["product"]))
    store("promotions", clean.clean_promotions(changed("causal_data", weeks)))
    fresh = {table: spark.read.schema(spark.read.parquet(after[f"{table}/schema"]).schema).parquet(f"{version}/{table}") for table in ("transactions", "promotions")}
    store("promo_store_weeks", fresh["promotions"].select("store_id", WEEK).distinct())
    store("weekly_category_sales", clean.weekly_category_sales(fresh["transactions"]))
    store("baskets", clean.baskets(fresh["transactions"]))

    stores = clean.promo_stores(_read(spark, after, "promo_store_weeks"))
    sales = lambda lines, promotions: clean.weekly_product_store_sales(lines, raw["product"], promotions, stores, params)
    store("weekly_product_store_sales", sales(changed("transaction_data", weeks), fresh["promotions"]))
    again = set() if weeks is None else _weeks_of_changed_stores(spark, before, after, stores) - weeks
    if again:
        promotions = _read(spark, after, "promotions").where(_in(again))
        store("weekly_product_store_sales", sales(changed("transaction_data", again), promotions), again, "-again")
    published.publish(after)
    return week_tables(spark, out)


def _weeks_of_changed_stores(spark: SparkSession, before: Mapping[str, str], after: Mapping[str, str], stores: DataFrame) -> set:
    """Weeks with sales in stores that are tracked now and were not, or the other way round; at most all weeks of the calendar."""
    known = clean.promo_stores(_read(spark, before, "promo_store_weeks"))
    differ = known.subtract(stores).unionByName(stores.subtract(known))
    sold = _read(spark, after, "weekly_product_store_sales").join(differ, "store_id", "left_semi")
    return {r[WEEK] for r in sold.select(WEEK).distinct().collect()}
