"""The weekly report as five tables per week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SHEETS = ("Summary", "Departments", "Categories", "Rising", "Falling")


def report_sheets(headline: DataFrame, departments: DataFrame, categories: DataFrame, movers: DataFrame) -> dict[str, DataFrame]:
    def of(direction: str) -> DataFrame:
        return movers.where(F.col("direction") == direction).drop("direction")

    return dict(zip(SHEETS, (headline, departments, categories, of("rising"), of("falling"))))


def write_report(sheets: dict[str, DataFrame], path: str, week: Column, fmt: str = "parquet") -> dict[str, str]:
    """Write every sheet under ``<path>/<sheet>/week_no=<N>``; other weeks stay as they are."""
    written = {}
    for name, df in sheets.items():
        target = f"{path.rstrip('/')}/{name}"
        writer = df.withColumn("week_no", week).write.mode("overwrite").partitionBy("week_no")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(target)
        written[name] = target
    return written
