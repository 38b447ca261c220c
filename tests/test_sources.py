import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelflift.params import Params
from shelflift.plans import rebuild
from shelflift.plans.layers import TABLES, Layers
from shelflift.plans.rebuild import load_raw, rebuild_all, refresh_report, stored_raw
from shelflift.plans.refresh import refresh_weeks
from shelflift.schema import SOURCE_TABLES
from shelflift.sources.csv import load_counts, load_csv, read_source_csv
from shelflift.sources.published import Publication
from shelflift.sources.retail_fixture import retail_tables
from shelflift.sources.tables import clear_scratch, materialize, read_table, scratch_path

SMALL = "/root/testdata/sf0.001"


def write(path, text, bom=True):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def test_columns_are_matched_by_name(spark, tmp_path):
    write(tmp_path / "coupon.csv", "CAMPAIGN,PRODUCT_ID,COUPON_UPC\n3,2,1\n,5,4\n")
    rows = load_csv(spark, str(tmp_path), ["coupon"])["coupon"].orderBy("coupon_upc").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3), (4, 5, None)]
    assert rows[0].asDict() == {"coupon_upc": 1, "product_id": 2, "campaign": 3}


def test_fields_are_read_as_a_bulk_load_reads_them(spark, tmp_path):
    """Doubled quotes, commas, backslashes, quoted empty against absent fields; with and without a line break in a field."""
    schema = "product_id bigint, commodity_desc string, brand string"
    lines = ['1,"24"" PIZZA",A', '2,"A, ""B"", C",', '3,"x\\",""', '4,"",x\\y', '5, padded ,"""quoted"""']
    want = [(1, '24" PIZZA', "A"), (2, 'A, "B", C', None), (3, "x\\", ""), (4, "", "x\\y"), (5, " padded ", '"quoted"')]
    for i, (more, row) in enumerate([([], []), (['6,"two\nlines, ""so""",B'], [(6, 'two\nlines, "so"', "B")])]):
        path = str(tmp_path / f"{i}.csv")
        write(path, "\n".join(["PRODUCT_ID,COMMODITY_DESC,BRAND", *lines, *more]) + "\n")
        assert [tuple(r) for r in read_source_csv(spark, path, schema).orderBy("product_id").collect()] == want + row
    write(tmp_path / "empty.csv", 'product_id,commodity_desc,brand\n"",a,b\n')
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cast"):
        read_source_csv(spark, str(tmp_path / "empty.csv"), schema).collect()


def test_analysis_queries_do_not_need_the_corpus_operators(monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "shelflift.llm", None)  # an import of it fails
    monkeypatch.setitem(sys.modules, "shelflift.llm.queries", None)
    names = entry.queries()
    assert "uplift_summary" in names and not any(n.startswith("op") and n[2].isdigit() for n in names) and set(entry.oracle_sql()) <= set(names)


def test_bad_values_and_missing_columns_fail(spark, tmp_path):
    write(tmp_path / "bad.csv", "coupon_upc,product_id,campaign\n1,x,3\n", bom=False)
    with pytest.raises(Exception, match="x"):
        read_source_csv(spark, str(tmp_path / "bad.csv"), SOURCE_TABLES["coupon"]).collect()
    write(tmp_path / "short.csv", "coupon_upc,campaign\n1,3\n")
    with pytest.raises(ValueError, match="product_id"):
        read_source_csv(spark, str(tmp_path / "short.csv"), SOURCE_TABLES["coupon"])


def test_counts_after_loading(spark, tmp_path):
    write(tmp_path / "campaign_desc.csv", "description,campaign,start_day,end_day\nTypeA,1,224,263\n")
    counts = load_counts(load_csv(spark, str(tmp_path), ["campaign_desc"])).collect()
    assert [tuple(r) for r in counts] == [("campaign_desc", 1)]


def test_rebuild_then_report_only(spark, tmp_path):
    raw, out = retail_tables(spark, SMALL), str(tmp_path / "out")
    with pytest.raises(RuntimeError, match="campaign results"):
        rebuild_all(spark, raw, out, reuse_campaigns=True)
    layers = rebuild_all(spark, raw, out, Params(mover_min_sales=1))
    stored = {name for name, table in TABLES.items() if table.stored}
    assert Publication(spark, out).current() == {name: layers.path(name) for name in stored}
    assert all(os.path.isdir(layers.path(name)) for name in stored)
    rebuild_all(spark, raw, out, week=60, report_only=True)
    weeks = {r.week_no for r in spark.read.parquet(f"{out}/reports/Categories").select("week_no").distinct().collect()}
    assert 60 in weeks and len(weeks) == 2


def test_a_run_that_fails_leaves_what_was_there(spark, tmp_path, monkeypatch):
    raw, out = retail_tables(spark, SMALL), str(tmp_path / "out")
    store_all, few = Layers.store_all, ["promo_stores", "weekly_category_sales", "campaign_did"]
    monkeypatch.setattr(Layers, "store_all", lambda self, names: store_all(self, few))
    monkeypatch.setattr(rebuild, "weekly", None)  # the report is not asked for here: the run ends when the tables are published
    with pytest.raises(AttributeError):
        rebuild_all(spark, raw, out)
    before = Publication(spark, out).current()
    counts = {name: read_table(spark, before[name]).count() for name in few}

    def broken(self):
        raise OSError("lost")

    monkeypatch.setitem(TABLES, "promo_stores", replace(TABLES["promo_stores"], build=broken))
    with pytest.raises(OSError, match="lost"):
        rebuild_all(spark, raw, out)
    assert Publication(spark, out).current() == before
    assert {name: read_table(spark, before[name]).count() for name in few} == counts


def test_versions_that_no_kept_set_names_go(spark, tmp_path):
    tables, seen = Publication(spark, str(tmp_path / "out")), []
    assert tables.current() == {}
    for i in range(4):
        version = tables.begin()
        spark.range(i + 1).write.parquet(f"{version}/numbers")
        kept = {"first": seen[0]["numbers"]} if seen else {}
        tables.publish({"numbers": f"{version}/numbers"} | kept)
        seen.append(tables.current())
    assert spark.read.parquet(tables.current()["numbers"]).count() == 4
    assert [os.path.isdir(s["numbers"]) for s in seen] == [True, False, True, True]  # the first is still named
    abandoned = tables.begin()
    os.makedirs(abandoned)
    tables.publish(seen[-1])
    assert os.path.isdir(abandoned)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_table_is_dealt_once(spark, tmp_path):
    path = str(tmp_path / "dealt")
    rows = spark.range(1000).selectExpr("id % 50 AS a", "id % 7 AS b", "id AS c")
    stored = materialize(rows, path, cluster_by=("a", "b", "c"), bucket_by=("a", "b"), buckets=3)
    again = spark.newSession()
    for df in (stored, read_table(again, path)):
        sums = df.groupBy("a", "b").count()
        assert "Exchange" not in plan_of(sums) and sums.count() == 350
        assert "Exchange" not in plan_of(df.hint("merge").join(df.select("a", "b").distinct(), ["a", "b"]))
    assert read_table(spark, path, ["c"]).agg({"c": "sum"}).first()[0] == 499_500
    materialize(rows.limit(10), path, bucket_by=("a", "b"), buckets=2)
    assert read_table(spark, path).count() == 10


def test_pairs_are_read_without_an_exchange(spark):
    layers = Layers(retail_tables(spark, SMALL), Params())
    pair = re.compile(r"Exchange hashpartitioning\(product_id#\d+L?, store_id")
    for name in ("baseline", "ps_all_baseline", "placebo_test"):
        assert not pair.search(plan_of(layers[name])), name
    assert "SelectedBucketsCount" in plan_of(layers["placebo_test"])


def test_source_tables_are_loaded_once(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(RuntimeError, match="load-raw"):
        stored_raw(spark, out)
    folder, raw = tmp_path / "csv", retail_tables(spark, SMALL)
    for name in SOURCE_TABLES:
        raw[name].write.csv(str(folder / f"{name}.csv"), header=True)
    load_raw(spark, str(folder), out)
    stored = stored_raw(spark, out)
    assert {n: df.dtypes for n, df in stored.items()} == {n: raw[n].dtypes for n in SOURCE_TABLES}
    for name in SOURCE_TABLES:
        assert stored[name].count() == raw[name].count()


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Nameless:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            applicationId, master = "app", "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Nameless, "x")


def test_scratch_is_cleared(spark, monkeypatch, tmp_path):
    from shelflift.sources import tables

    monkeypatch.setattr(tables, "_scratch_folder", lambda s: str(tmp_path / "scratch"))
    path = scratch_path(spark, "numbers")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    clear_scratch(spark)
    assert not os.path.exists(tmp_path / "scratch")


def _same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_refreshed_weeks_equal_a_full_build(spark, tmp_path):
    raw, p = dict(retail_tables(spark, SMALL)), Params()
    lines, placed = raw["transaction_data"].where("week_no in (40, 41, 42)"), raw["causal_data"].where("week_no in (40, 41, 42)")
    # One store has placements in week 42 only, and sells in weeks 40 and 42.
    store = lines.where("week_no = 40 and quantity > 0 and sales_value > 0").first().store_id
    lines = lines.where(f"store_id <> {store} or week_no <> 41").unionByName(lines.limit(1).withColumn("week_no", F.lit(None).cast(dict(lines.dtypes)["week_no"])))
    placed = placed.where(f"store_id <> {store}").unionByName(
        placed.where("week_no = 42").limit(1).withColumn("store_id", F.lit(store).cast(dict(placed.dtypes)["store_id"])))
    raw |= {"transaction_data": _kept(lines, tmp_path / "lines"), "causal_data": _kept(placed, tmp_path / "placed")}
    whole = refresh_weeks(spark, raw, str(tmp_path / "whole"), params=p)
    layers = Layers(raw, p)
    for name in ("transactions", "promotions", "weekly_product_store_sales", "weekly_category_sales", "baskets"):
        assert _same(whole[name], layers[name]), name

    out = str(tmp_path / "out")
    earlier = raw | {n: raw[n].where("week_no in (40, 41) or week_no is null") for n in ("transaction_data", "causal_data")}
    refresh_weeks(spark, earlier, out, params=p)
    tables = Publication(spark, f"{out}/weekly")
    first = tables.current()
    parts = refresh_weeks(spark, raw, out, [42], p)
    assert all(_same(parts[name], whole[name]) for name in whole)
    kept = {n for n, path in tables.current().items() if first.get(n) == path}
    assert {f"{t}/week={w}" for t in ("transactions", "baskets", "weekly_category_sales") for w in (40, 41)} <= kept
    # The store's tracking has changed, so week 40, where it sold, is new, and week 41 is not.
    assert "weekly_product_store_sales/week=41" in kept and "weekly_product_store_sales/week=40" not in kept
    assert not any(n.endswith("week=42") for n in kept)
    # A week that is gone, and one that comes again as it was.
    parts = refresh_weeks(spark, earlier, out, [42, 41, None], p)
    full = refresh_weeks(spark, earlier, str(tmp_path / "earlier"), params=p)
    assert all(_same(parts[name], full[name]) for name in full)
    none = {n: df.limit(0) for n, df in raw.items()}
    assert all(df.isEmpty() for df in refresh_weeks(spark, none, str(tmp_path / "none")).values())


def _kept(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_report_of_a_refresh(spark, tmp_path):
    raw, out = retail_tables(spark, SMALL), str(tmp_path / "out")
    refresh_report(spark, raw, out, [60], Params(mover_min_sales=1), week=60)
    assert {r.week_no for r in spark.read.parquet(f"{out}/reports/Categories").select("week_no").distinct().collect()} == {60}
