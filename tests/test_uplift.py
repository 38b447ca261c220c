from decimal import Decimal as D

import pytest

from shelflift.operators import cannibal, placebo, uplift
from shelflift.params import Params

P = Params()
WEEKS = ("product_id bigint, store_id int, week_no int, department string, commodity_desc string, "
         "sub_commodity_desc string, sales decimal(20,2), discount decimal(20,2), adj_sales double, promoted boolean")
PROMOS = ("product_id bigint, store_id int, week_no int, display string, mailer string, on_display boolean, "
          "in_mailer boolean")


def sold(product, week, adj=1.0, sub="RYE", promoted=False):
    return (product, 1, week, "GROCERY", "BREAD", sub, D("1.00"), D("0.10"), float(adj), promoted)


def promo(product, week, display="3", mailer="0"):
    return (product, 1, week, display, mailer, display != "0", mailer != "0")


def pairs_of(frame, sales, promos):
    timeline = uplift.promotion_timeline(frame(WEEKS, sales), frame(PROMOS, promos), P)
    return uplift.pair_timeline(timeline, P)


def test_season_index_is_limited(frame):
    weekly = frame("department string, week_no int, sales decimal(20,2)",
                   [("A", w, D("10.00")) for w in range(9, 59)] + [("A", 60, D("100.00")), ("A", 61, D("0.10")),
                    ("A", 8, D("9999.00")), ("B", 9, D("3.00"))])
    idx = {(r.department, r.week_no): r.season_idx for r in uplift.season_index(weekly, P).collect()}
    assert idx["A", 60] == 2.0 and idx["A", 61] == 0.5 and idx["B", 9] == 1.0 and ("A", 8) not in idx


def test_candidates_need_eight_sale_weeks(frame):
    sales = [sold(1, w) for w in range(9, 16)] + [sold(2, w, promoted=w == 9) for w in range(9, 17)]
    pairs = pairs_of(frame, sales, [promo(1, 9), promo(2, 9)])
    assert [r.product_id for r in uplift.ps_candidates(frame(WEEKS, sales), P).collect()] == [2]
    assert [(r.product_id, r.week_no) for r in uplift.promo_weeks(pairs, P).collect()] == [(2, 9)]
    assert {r.product_id for r in cannibal.ps_all_baseline(pairs, P).collect()} == {1, 2}


def test_baseline_needs_thirteen_normal_weeks_and_divides_by_all_of_them(frame):
    sales = [sold(p, w, 2.0) for p in (1, 2, 3) for w in range(94, 102)]
    promos = ([promo(1, w) for w in range(9, 89)] + [promo(2, w) for w in range(9, 90)]
              + [promo(3, w) for w in range(9, 102)])
    pairs = pairs_of(frame, sales, promos)
    rows = {r.product_id: r for r in uplift.baseline(pairs, P).collect()}
    assert set(rows) == {1}
    assert (rows[1].promo_weeks, rows[1].normal_weeks) == (80, 13)
    assert rows[1].baseline_weekly == pytest.approx(16 / 13)
    assert {r.product_id for r in cannibal.ps_all_baseline(pairs, P).collect()} == {1, 2}


def test_week_after_a_promotion(frame):
    sales = [sold(1, w, 1.0) for w in range(9, 20)] + [sold(1, 50, 5.0), sold(1, 52, 3.0)]
    pairs = pairs_of(frame, sales, [promo(1, 50), promo(1, 51), promo(1, 70), promo(1, 101)])
    rows = {r.week_no: r for r in uplift.promo_week_uplift(pairs, P).collect()}
    base = 14 / 89
    assert rows[50].incremental_sales == pytest.approx(5 - base) and rows[50].next_week_change is None
    assert rows[51].actual_sales == 0 and rows[51].next_week_change == pytest.approx(3 - base)
    assert rows[70].next_week_change == pytest.approx(-base)
    assert rows[101].next_week_change is None
    assert {r.week_no for r in uplift.pull_forward(uplift.promo_week_uplift(pairs, P)).collect()} == {51, 70}


def test_summary_levels_add_up_and_single_pair_has_no_range(frame):
    sales = [sold(1, w, 1.0 + w % 3) for w in range(9, 40)]
    promos = [promo(1, 20), promo(1, 21, "0", "A"), promo(1, 22, "7", "D"), promo(1, 23, "0", "X")]
    up = uplift.promo_week_uplift(pairs_of(frame, sales, promos), P)
    rows = {(r.level[0], r.placement): r for r in uplift.uplift_summary(up, P).collect()}
    assert set(rows) == {("1", "display only"), ("1", "mailer only"), ("1", "display + mailer"), ("2", "3"), ("3", "A"),
                         ("3", "X")}
    assert sum(r.promo_weeks for k, r in rows.items() if k[0] == "1") == up.count()
    assert all(r.ci95 is None for r in rows.values())
    summary = uplift.uplift_summary(up, P)
    assert "X" not in {r.placement for r in uplift.placement_labels(summary).collect()}
    assert {r.placement for r in uplift.bi_promo_uplift(summary).collect()} >= {"Front end cap", "Interior page feature"}


def test_placebo_centres_on_zero(frame):
    import random

    draw = random.Random(5)
    sales = [sold(p, w, draw.expovariate(0.5), promoted=w < 15)
             for p in range(1, 61) for w in range(9, 102) if draw.random() < 0.6 or w < 20]
    pairs = pairs_of(frame, sales, [promo(p, w) for p in range(1, 61) for w in range(9, 15)])
    runs = placebo.placebo_test(pairs, P)
    out = placebo.placebo_summary(runs).first()
    assert out.runs == 20 and out.ranges_with_zero >= 15 and abs(out.mean_fake_extra) < 0.05
    assert {r.fake_weeks for r in runs.collect()} == {600}


def test_subcategory_week_merges_sales_and_promotions(frame):
    sales = [sold(1, w, 2.0) for w in range(9, 60)] + [sold(2, w, 1.0) for w in range(9, 60)]
    pairs = pairs_of(frame, sales, [promo(1, 20), promo(2, 20, "0", "A"), promo(1, 70)])
    rows = {r.week_no: r for r in cannibal.subcat_weeks(pairs, P).collect()}
    assert rows[20].promo_week and rows[20].promo_type == "mixed" and rows[20].promoted_products == 2
    assert rows[20].total_sales == 3.0 and not rows[21].promo_week and rows[21].promo_type is None
    assert rows[70].promo_week and rows[70].total_sales == 0 and rows[70].promo_type == "display only"


def test_subcategory_without_name_keeps_sales_and_promotion_apart(frame):
    pairs = pairs_of(frame, [sold(1, w, sub=None) for w in range(9, 30)], [promo(1, 20)])
    rows = sorted((r.promo_week, r.total_sales) for r in cannibal.subcat_weeks(pairs, P).collect() if r.week_no == 20)
    assert rows == [(False, 1.0), (True, 0.0)]


def test_subcategory_with_promoted_rows_only(frame):
    pairs = pairs_of(frame, [sold(1, w, 2.0, promoted=True) for w in range(20, 25)], [promo(1, w) for w in range(20, 25)])
    weeks = cannibal.subcat_weeks(pairs, P)
    assert cannibal.subcat_baseline(weeks, P).first().baseline_weekly is None
    assert cannibal.subcat_baseline(weeks, P, "zero").first().baseline_weekly == 0
    overall = cannibal.cannibalisation_summary(weeks, P).where("level = '1. overall'").first()
    assert overall.promoted_extra == 10 and overall.category_extra is None
    filled = cannibal.cannibalisation_summary(weeks, P, "zero").where("level = '1. overall'").first()
    assert filled.category_extra == 10 and filled.taken_from_similar == 0


def test_cutting_departments_needs_a_clear_effect(frame):
    from shelflift.operators import recommend

    weeks = frame("department string, incremental_sales double, discount decimal(20,2)",
                  [("A", 5.0, D("2.00")), ("A", 5.0, D("3.00")), ("B", 9.0, D("1.00"))])
    summary = frame("level string, grp string, subcat_stores bigint, promoted_extra double, taken_from_similar double, "
                    "taken_ci95 double, cannibalised_pct double",
                    [("3. department", "A", 600, 10.0, 4.0, 1.0, 40.0), ("3. department", "B", 600, 9.0, 4.0, 5.0, 44.0),
                     ("3. department", "C", 400, 9.0, 4.0, 1.0, 44.0)])
    row = recommend.rec_cut_departments(weeks, summary, P).collect()
    assert [r.department for r in row] == ["A"]
    assert row[0].net_extra == pytest.approx(6.0) and row[0].net_extra_per_discount_dollar == pytest.approx(1.2)
