"""Rebuild all stored tables in dependency order and write the weekly report."""

from __future__ import annotations

import argparse
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from shelflift.operators import weekly
from shelflift.params import Params
from shelflift.plans.layers import TABLES, Layers
from shelflift.plans.refresh import refresh_weeks
from shelflift.schema import SOURCE_TABLES
from shelflift.sources.csv import load_csv
from shelflift.sources.published import Publication
from shelflift.sources.report import report_sheets, write_report
from shelflift.sources.tables import clear_scratch

REPORT_INPUTS = ("dim_week", "fact_baskets", "fact_category_week")
CAMPAIGN_RESULTS = "campaign_did"
CAMPAIGN_STEPS = {
    "campaign_spend", "did_members_never", "did_members_other", "did_panel_never", "did_panel_other_times",
    "did_never", "did_other", "pretrend_never", "pretrend_other",
}


def load_raw(spark: SparkSession, folder: str, out: str) -> None:
    """Read the eight CSV files once and publish them as typed tables under ``<out>/raw``, all at once."""
    source = Publication(spark, f"{out.rstrip('/')}/raw")
    version = source.begin()
    for name, df in load_csv(spark, folder).items():
        # Sorted by week where there is one, so that a refresh of some weeks skips the files of others.
        rows = df.repartitionByRange("week_no", "product_id", "store_id").sortWithinPartitions("week_no") if "week_no" in df.columns else df
        rows.write.parquet(f"{version}/{name}")
    source.publish({name: f"{version}/{name}" for name in SOURCE_TABLES})


def stored_raw(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The stored source tables; stops when they were never loaded."""
    stored = Publication(spark, f"{out.rstrip('/')}/raw").current()
    if not stored:
        raise RuntimeError("there are no stored source tables; run once with --load-raw")
    return {name: spark.read.parquet(stored[name]) for name in SOURCE_TABLES}


def rebuild_all(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out: str,
    params: Params = Params(),
    week: int | None = None,
    report_only: bool = False,
    reuse_campaigns: bool = False,
) -> Layers:
    """Write every stored table into a new version under ``<out>``, publish all of them at once, and write the report under ``<out>/reports``.

    Independent tables are built at the same time. A run that fails leaves the tables published before. ``report_only`` reads these
    instead. ``reuse_campaigns`` keeps the stored campaign results and stops when there are none.
    """
    tables = Publication(spark, out)
    before = tables.current()
    layers = Layers(raw, params, store=tables.begin())
    if report_only:
        if not set(REPORT_INPUTS) <= set(before):
            raise RuntimeError("there are no stored tables; rebuild them first")
        for name in REPORT_INPUTS:
            layers.reuse(spark, name, before[name])
    else:
        kept = [name for name in before if name in CAMPAIGN_STEPS or name == CAMPAIGN_RESULTS] if reuse_campaigns else []
        if reuse_campaigns and CAMPAIGN_RESULTS not in kept:
            raise RuntimeError("there are no stored campaign results; rebuild them first")
        for name in kept:
            layers.reuse(spark, name, before[name])
        stored = [name for name, table in TABLES.items() if table.stored and not (reuse_campaigns and name in CAMPAIGN_STEPS)]
        layers.store_all(stored)
        tables.publish({name: layers.path(name) for name in [*stored, *kept]})
    _report(layers, out, week)
    return layers


def _report(layers: Layers, out: str, week: int | None) -> None:
    chosen = weekly.report_week(layers["dim_week"], week)
    categories = weekly.weekly_category_report(layers["fact_category_week"], chosen)
    sheets = report_sheets(
        weekly.weekly_headline(layers["fact_baskets"], chosen),
        weekly.weekly_department_report(categories),
        categories,
        weekly.weekly_movers(categories, layers.p),
    )
    write_report(sheets, f"{out.rstrip('/')}/reports", chosen)


def refresh_report(spark: SparkSession, raw: Mapping[str, DataFrame], out: str, weeks: Iterable[int], params: Params = Params(), week: int | None = None) -> Layers:
    """The weekly job: build the changed weeks again, and write the report from the tables stored by week."""
    layers = Layers(raw, params)
    for name, df in refresh_weeks(spark, raw, out, weeks, params).items():
        if name in TABLES:
            layers.take(name, df)
    _report(layers, out, week)
    return layers


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("out", help="folder for the source tables, the layer tables and the reports")
    parser.add_argument("--load-raw", metavar="FOLDER", help="first load the eight CSV files of this folder")
    parser.add_argument("--week", type=int, help="week of the report (default: the latest complete week)")
    parser.add_argument("--report-only", action="store_true", help="use the stored tables")
    parser.add_argument("--reuse-campaigns", action="store_true", help="keep the stored campaign results")
    parser.add_argument("--refresh-weeks", type=int, nargs="+", metavar="WEEK", help="build only these weeks again, and the report (the first time: all weeks)")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("shelflift").config("spark.ui.enabled", "false").getOrCreate()
    if args.load_raw:
        load_raw(spark, args.load_raw, args.out)
    raw = stored_raw(spark, args.out)
    if args.refresh_weeks:
        refresh_report(spark, raw, args.out, args.refresh_weeks, week=args.week)
    else:
        rebuild_all(spark, raw, args.out, week=args.week, report_only=args.report_only, reuse_campaigns=args.reuse_campaigns)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
