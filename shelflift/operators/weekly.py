"""The weekly category report.

``week`` is a week number or, by default, the latest complete week as a scalar subquery, so that nothing is
collected before the report is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.functions.columns import pct_change, ratio, sum_where
from shelflift.params import Params

MONEY = ["sales_this_week", "sales_last_week", "avg_last_4_weeks", "same_week_last_year"]


def latest_complete_week(weeks: DataFrame) -> DataFrame:
    return weeks.where("complete_week").agg(F.max("week_no").alias("week_no"))


def report_week(weeks: DataFrame, week: int | None = None) -> Column:
    return F.lit(week) if week is not None else latest_complete_week(weeks).scalar()


def _changes() -> dict[str, Column]:
    this = F.col("sales_this_week")
    return {
        "vs_last_week": pct_change(this, F.col("sales_last_week")),
        "vs_4_week_avg": pct_change(this, F.col("avg_last_4_weeks")),
        "vs_last_year": pct_change(this, F.col("same_week_last_year")),
    }


def weekly_category_report(category_weeks: DataFrame, week: Column) -> DataFrame:
    """Sales of the week against last week, the last four weeks and last year, per category."""
    span = category_weeks.where(F.col("week_no").between(week - 52, week)).withColumn("ago", week - F.col("week_no"))
    ago = F.col("ago")

    def sales(cond: Column) -> Column:
        return F.coalesce(sum_where(cond, F.col("sales")).cast("double"), F.lit(0.0))

    rows = span.groupBy("department", F.col("commodity_desc").alias("category")).agg(
        sales(ago == 0).alias("sales_this_week"),
        sales(ago == 1).alias("sales_last_week"),
        (sales(ago.between(1, 4)) / 4).alias("avg_last_4_weeks"),
        sales(ago == 52).alias("same_week_last_year"),
        F.coalesce(sum_where(ago == 0, F.col("discount")).cast("double"), F.lit(0.0)).alias("discount"),
    )
    this = F.col("sales_this_week")
    everything = span.where(ago == 0).agg(F.sum("sales")).scalar()
    return rows.withColumns({
        **_changes(),
        "discount_pct": F.when(this > 0, F.col("discount") / this),
        "share_of_sales": ratio(this, everything),
    }).drop("discount").orderBy(F.desc("sales_this_week"), "department", "category")


def weekly_department_report(categories: DataFrame) -> DataFrame:
    """The category report rolled up by department."""
    rows = categories.groupBy("department").agg(*[F.sum(m).alias(m) for m in MONEY])
    everything = categories.agg(F.sum("sales_this_week")).scalar()
    return rows.withColumns({
        **_changes(), "share_of_sales": ratio(F.col("sales_this_week"), everything),
    }).orderBy(F.desc("sales_this_week"), "department")


def weekly_headline(trips: DataFrame, week: Column) -> DataFrame:
    """Sales, households, trips and basket value: the week against the week before."""
    near = trips.where(F.col("week_no").between(week - 1, week)).withColumn("ago", week - F.col("week_no"))
    per_week = near.groupBy("ago").agg(
        F.sum("basket_value").cast("double").alias("sales"),
        F.countDistinct("household_key").cast("double").alias("households"),
        F.count(F.lit(1)).cast("double").alias("trips"),
    ).withColumn("basket_value", F.col("sales") / F.col("trips"))
    metrics = ["sales", "households", "trips", "basket_value"]

    def value(metric: str, ago: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("ago") == ago, F.col(metric))), F.lit(0.0))

    wide = per_week.agg(*[value(m, a).alias(f"{m}_{a}") for m in metrics for a in (0, 1)])
    rows = F.array(*[
        F.struct(
            F.lit(m.replace("_", " ").capitalize()).alias("metric"),
            F.col(f"{m}_0").alias("this_week"), F.col(f"{m}_1").alias("last_week"),
            pct_change(F.col(f"{m}_0"), F.col(f"{m}_1")).alias("change"),
        )
        for m in metrics
    ])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def weekly_movers(categories: DataFrame, p: Params) -> DataFrame:
    """The categories that rose and fell most against their 4-week average."""
    change = F.col("change_vs_4_week_avg")
    steady = categories.where(F.col("avg_last_4_weeks") >= p.mover_min_sales).select(
        "department", "category", "sales_this_week", "avg_last_4_weeks",
        (F.col("sales_this_week") - F.col("avg_last_4_weeks")).alias("change_vs_4_week_avg"), "vs_4_week_avg",
    )

    def top(direction: str, rows: DataFrame, order: Column) -> DataFrame:
        return rows.orderBy(order, "department", "category").limit(p.movers).withColumn(
            "direction", F.lit(direction))

    return top("rising", steady.where(change > 0), change.desc()).unionByName(
        top("falling", steady.where(change < 0), change.asc())
    )
