"""Run registered queries on Spark and their SQL on DuckDB over the same files and compare all rows.

Usage: python tests/parity.py <data folder> [query ...]
"""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
                 "benchmark labels conversations").split()


def _scratch() -> str:
    """A folder for this process's session, which runs on this machine alone; removed at the end."""
    folder = tempfile.mkdtemp(prefix="shelflift-session-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def session(cores: str = "8", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("shelflift")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", _scratch())
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return f"{v:.6f}"
    return str(v)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> tuple[str, int, float, float]:
    """(verdict, rows, Spark seconds, DuckDB seconds)"""
    t = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    spark_s = time.time() - t
    if sql is None:
        return "rows only", len(got), spark_s, 0.0
    t = time.time()
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    types = [str(d[1]) for d in res.description]
    want = res.fetchall()
    duck_s = time.time() - t
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS spark={sorted(df.columns)} duck={sorted(columns)}", len(got), spark_s, duck_s
    bad = [f"{c}:{k}" for c, k in zip(columns, types) if k == "HUGEINT" or k.startswith("DECIMAL")]
    if bad:
        return f"TYPES {bad}", len(got), spark_s, duck_s
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return f"ROWS spark={len(a)} duck={len(b)}", len(got), spark_s, duck_s
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return f"VALUES {len(diff)} differ, columns {sorted(columns)}: {diff[:2]}", len(got), spark_s, duck_s
    return "ok", len(got), spark_s, duck_s


def main() -> None:
    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    queries, sqls = entry.queries(), entry.oracle_sql()
    spark, con = session(), duck(sf_dir)
    bad = 0
    for name in wanted or queries:
        try:
            verdict, n, spark_s, duck_s = compare(spark, con, name, queries[name], sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            verdict, n, spark_s, duck_s = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0, 0.0, 0.0
        bad += verdict not in ("ok", "rows only")
        print(f"{name:32s} {n:8d} {spark_s:6.2f}s {duck_s:6.2f}s  {verdict}", flush=True)
    print(f"{bad} bad of {len(wanted or queries)}; {len(sqls)} with SQL")


if __name__ == "__main__":
    main()
