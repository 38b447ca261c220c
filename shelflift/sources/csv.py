"""Reading the eight source CSV files."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelflift.schema import SOURCE_TABLES

BYTE_ORDER_MARK = "﻿"


# Stands for a quoted empty field until an absent one, which is NULL, can be told from it.
_EMPTY = "\x01empty\x01"


def _has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some field holds a line break: then some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_source_csv(spark: SparkSession, path: str, schema: str, line_breaks: bool | None = None) -> DataFrame:
    """One CSV with a header: columns are matched by lower-cased header name, in any order.

    The dialect is that of a database's bulk load: a quote inside a quoted field is doubled, a backslash is a character like any other, an absent field is NULL
    and a quoted empty one is an empty text. Fields may hold line breaks; files that do are read by one task each, as they cannot be split, and all
    others in splits. ``line_breaks`` tells which it is; by default the file is looked through.

    The reader gets no schema because Spark would bind one by position; all columns arrive as text and
    are cast by name. Malformed rows and values that do not fit their type fail the load.
    """
    multi = _has_line_breaks(spark, path) if line_breaks is None else line_breaks
    raw = spark.read.csv(path, header=True, encoding="UTF-8", mode="FAILFAST", quote='"', escape='"', emptyValue=_EMPTY, multiLine=multi)
    by_name = raw.toDF(*[c.strip(BYTE_ORDER_MARK + " ").lower() for c in raw.columns])
    fields = T.StructType.fromDDL(schema).fields
    missing = [f.name for f in fields if f.name not in by_name.columns]
    if missing:
        raise ValueError(f"{path}: header lacks {missing}")
    value = lambda c: F.when(F.col(c) == _EMPTY, "").otherwise(F.col(c))
    return by_name.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in fields])


def load_csv(spark: SparkSession, folder: str, tables: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The source tables found as ``<folder>/<table>.csv``; pass ``tables`` to read only some."""
    names = list(tables) if tables is not None else list(SOURCE_TABLES)
    return {n: read_source_csv(spark, f"{folder.rstrip('/')}/{n}.csv", SOURCE_TABLES[n]) for n in names}


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for every loaded table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
