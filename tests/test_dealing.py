"""What travels, how often, and in how many parts; and that the results stay those of the plain definition."""

import datetime as dt
import re
import time
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal as D

from pyspark.sql import DataFrame

from shelflift.functions import ranking
from shelflift.functions.columns import deal
from shelflift.operators import clean, quality, uplift
from shelflift.params import Params
from shelflift.plans.layers import Layers
from shelflift.plans.refresh import refresh_weeks
from shelflift.schema import SOURCE_TABLES
from shelflift.sources.retail_fixture import retail_tables

TX, PRODUCT, CAUSAL = (SOURCE_TABLES[n] for n in ("transaction_data", "product", "causal_data"))
HASHED = "Exchange hashpartitioning"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def line(basket, product, household=1, store=1, week=10, sales="2.00"):
    return (household, basket, 64, product, 1, D(sales), store, D("-0.50"), 900, week, D("0.00"), D("0.00"))


def test_dealt_rows_keep_the_number_of_partitions(spark):
    rows = deal(spark.range(10), "id").groupBy("id").count()
    assert plan_of(rows).count("Exchange") == 1
    assert rows.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and rows.count() == 10


def test_placements_are_sorted_after_the_exchange_only(frame):
    causal = frame(CAUSAL, [(1, 1, 9, "0", "A"), (1, 1, 9, "3", "0"), (None, 1, 9, "10", None), (None, 1, 9, "2", None)])
    rows = clean.clean_promotions(causal)
    plan = plan_of(rows)
    assert plan.count("Exchange") == 1 and "Sort" not in plan[plan.index("Exchange"):]
    assert {(r.product_id, r.display, r.mailer, r.on_display, r.in_mailer) for r in rows.collect()} == {
        (1, "3", "A", True, True), (None, "2", None, True, None)}


def test_lines_of_a_product_store_and_week_travel_once(frame):
    tx = frame(TX, [line(1, 1), line(1, 1), line(2, 1, household=2), line(3, 1, household=None), line(4, None), line(5, 1, week=None)])
    product = frame(PRODUCT, [(p, 1, "GROCERY", "National", "BREAD", "RYE", "1 OZ") for p in (1, None)])
    promotions = clean.clean_promotions(frame(CAUSAL, [(1, 1, 10, "3", "0")]))
    weekly = clean.weekly_product_store_sales(tx, product, promotions, clean.promo_stores(promotions), Params())
    assert not re.search(HASHED + r"\([^)]*household_key", plan_of(weekly))
    assert {(r.product_id, r.week_no, r.units, r.sales, r.discount, r.households, r.on_display) for r in weekly.collect()} == {
        (1, 10, 4, D("8.00"), D("2.00"), 2, True), (1, None, 1, D("2.00"), D("0.50"), 1, False)}


def test_timeline_keeps_the_number_of_partitions(frame, spark):
    weekly = frame("product_id bigint, store_id int, week_no int, department string, commodity_desc string, sub_commodity_desc string, "
                   "discount decimal(22,2), adj_sales double", [(1, 1, 10, "A", "B", "C", D("1.00"), 2.0)])
    promotions = clean.clean_promotions(frame(CAUSAL, [(1, 1, 11, "3", "0")]))
    timeline = uplift.pair_timeline(uplift.promotion_timeline(weekly, promotions, Params()), Params())
    assert timeline.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [(r.week_no, r.promoted, r.department) for r in timeline.orderBy("week_no").collect()] == [(10, False, "A"), (11, True, "A")]


def test_counts_of_trips_and_households_send_no_line_twice_over(frame):
    rows = [("A", "X", 1, 1, 1), ("A", "X", 1, 1, 1), ("A", "X", 1, 2, 1), ("A", "X", 1, 2, 2), ("A", "X", 1, None, 3), ("A", "X", 1, 3, None),
            (None, "X", None, 1, 1), (None, "X", None, 2, 1)]
    lines = frame("department string, commodity_desc string, week_no int, basket_id bigint, household_key int, quantity int, "
                  "sales_value decimal(10,2), retail_disc decimal(10,2), coupon_disc decimal(10,2), coupon_match_disc decimal(10,2)",
                  [(*r, 2, D("1.50"), D("0.10"), D("0.20"), D("0.00")) for r in rows])
    weekly = clean.weekly_category_sales(lines)
    assert "Expand" not in plan_of(weekly)
    assert {tuple(r) for r in weekly.collect()} == {
        ("A", "X", 1, D("9.00"), 12, D("1.80"), 3, 3), (None, "X", None, D("3.00"), 4, D("0.60"), 2, 1)}


def test_placement_conflicts_take_one_exchange(frame):
    rows = [(1, 1, 9, "0", "A"), (1, 1, 9, "0", "A"), (2, 1, 9, "0", "A"), (2, 1, 9, "0", None), (None, 1, 9, "0", "A"), (3, 1, 9, "0", "A")]
    found = quality.dq_causal_conflicts(frame(CAUSAL, rows))
    assert plan_of(found).count(HASHED) == 1
    assert tuple(found.first()) == (2, 1, 1)


def test_lines_read_in_enough_splits_are_not_dealt_again(spark, tmp_path):
    days = [dt.datetime(1996, 1, 1) + dt.timedelta(days=100 * i) for i in range(12)]
    lines = spark.createDataFrame([(i, 10 * i, 1, days[i]) for i in range(12)], "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate timestamp_ntz")
    part = spark.createDataFrame([(10 * i, "LARGE", 5) for i in range(12)], "p_partkey long, p_type string, p_size int")
    for folder, files in (("few", 1), ("many", 12)):
        lines.repartition(files).write.parquet(str(tmp_path / folder / "lineitem.parquet"))
        part.write.parquet(str(tmp_path / folder / "part.parquet"))
    few, many = (retail_tables(spark, str(tmp_path / folder))._build["causal_data"]() for folder in ("few", "many"))
    assert "RoundRobin" in plan_of(few) and "RoundRobin" not in plan_of(many)
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty() and few.count() > 0


def test_a_refresh_samples_nothing(frame, tmp_path, monkeypatch):
    spark = frame("a int", []).sparkSession
    raw = {"transaction_data": frame(TX, [line(b, 1, week=w) for b in range(40) for w in (10, 11, None)]),
           "causal_data": frame(CAUSAL, [(1, 1, 10, "3", "0")]), "product": frame(PRODUCT, [(1, 1, "GROCERY", "National", "BREAD", "RYE", "1 OZ")])}

    def fail(*args):
        raise AssertionError("a range exchange computes its input twice")

    monkeypatch.setattr(DataFrame, "repartitionByRange", fail)
    refresh_weeks(spark, raw, str(tmp_path / "out"), params=Params())
    tables = refresh_weeks(spark, raw, str(tmp_path / "out"), [10], Params())
    assert sorted((r.week_no or 0, r["count"]) for r in tables["transactions"].groupBy("week_no").count().collect()) == [(0, 40), (10, 40), (11, 40)]
    assert sorted((r.week_no or 0, r.units, r.promo_tracked) for r in tables["weekly_product_store_sales"].collect()) == [(0, 40, None), (10, 40, True), (11, 40, True)]
    # A week that is refreshed alone is dealt to all tasks.
    assert len({r.f for r in tables["transactions"].where("week_no = 10").selectExpr("input_file_name() AS f").collect()}) > 1


def test_row_counts_sum_the_trips_once(frame):
    raw = {"transaction_data": frame(TX, [line(1, 1), line(1, 1), line(2, 1, household=2), line(3, 1, week=11), line(4, 2)]),
           "product": frame(PRODUCT, [(1, 1, "GROCERY", "National", "BREAD", "RYE", "1 OZ")])}
    layers, one = Layers(raw, Params()), frame("campaign_type string", [("TypeA",)])
    for name in ("bi_promo_uplift", "did_never", "dim_household", "did_other", "bi_promo_cannibalisation", "bi_campaign_results"):
        layers.take(name, one)
    # A lazy table of an earlier query does not keep the trips from being stored.
    assert "hashpartitioning(basket_id" in plan_of(layers["baskets"])
    counts = layers["bi_row_counts"]
    assert "hashpartitioning(basket_id" not in plan_of(counts)
    assert [tuple(r) for r in counts.collect()] == [
        ("dim_week", 2), ("fact_baskets", 3), ("fact_category_week", 2), ("dim_household", 1), ("promo_uplift", 1),
        ("promo_cannibalisation", 1), ("campaign_results", 1)]


def test_cuts_are_searched_not_passed_through(frame):
    cuts, ties = [-2.0, 0.0, 1.5, 7.0], [10, 20, 30]
    rows = [(v, t) for v in (None, -3.0, -2.0, -1.0, 0.0, 1.5, 6.0, 7.0, 8.0, float("nan")) for t in (5, 10, 15, 30, 31)]
    limits = frame("g int, _value_cuts array<double>, _tie_cuts array<int>", [(1, cuts, ties)])
    found = ranking._bucketed(frame("g int, v double, t int", [(1, *r) for r in rows]), limits, "v", "t", ["g"], 5)
    assert "filter(_value_cuts" not in found._jdf.queryExecution().optimizedPlan().toString()

    def bucket(v, t):
        ties_below = sum(c < t for c in ties)
        if v is None:
            return ties_below - 6
        below = len(cuts) if v != v else sum(c < v for c in cuts)
        return (below * 2 + (v in cuts)) * 6 + (ties_below if v in cuts else 0)

    assert sorted((str(r.v), r.t, r._bucket) for r in found.collect()) == sorted((str(v), t, bucket(v, t)) for v, t in rows)
    # A group with nothing but NULL has no cuts.
    empty = frame("g int, _value_cuts array<double>, _tie_cuts array<int>", [(1, None, ties)])
    assert [r._bucket for r in ranking._bucketed(frame("g int, v double, t int", [(1, None, 15)]), empty, "v", "t", ["g"], 5).collect()] == [-5]


def test_threads_load_a_source_table_once(spark, tmp_path):
    tables, built = retail_tables(spark, str(tmp_path)), []

    def build():
        built.append(1)
        time.sleep(0.5)
        return spark.range(3)

    tables._build["product"] = build
    with ThreadPoolExecutor(2) as pool:
        assert [df.count() for df in pool.map(lambda _: tables["product"], range(2))] == [3, 3]
    assert len(built) == 1
