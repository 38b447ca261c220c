"""One DuckDB query per registered query, over the shared views."""

from __future__ import annotations

from shelflift import schema
from shelflift.operators.quality import NAMES

RESULTS: dict[str, str] = {}
FREE_ITEMS = ", ".join(f"'{code}'" for code in schema.FREE_ITEM_MAILERS)


def d(expr: str, name: str | None = None) -> str:
    """A double rounded to 6 places, without a negative zero."""
    return f"floor(CAST({expr} AS DOUBLE) * 1000000 + 0.501) / 1000000 + 0.0 AS {name or expr}"


def c(cents: str, name: str) -> str:
    """Cents as dollars."""
    return d(f"{cents} / 100.0", name)


def i(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def ds(*names: str) -> str:
    return ", ".join(d(n) for n in names)


# ---------------------------------------------------------------- loading

SOURCES = {
    "transaction_data": "v_tx", "product": "v_product", "hh_demographic": "v_demo", "campaign_table": "v_targets",
    "campaign_desc": "v_campaign_desc", "coupon": "v_coupon", "coupon_redempt": "v_redempt", "causal_data": "v_causal",
}
COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {v}" for t, v in SOURCES.items()
)
_CENTS = {"sales_value": "sales_c", "retail_disc": "retail_c", "coupon_disc": "coupon_c", "coupon_match_disc": "match_c"}


def _checksum(table: str, view: str) -> str:
    columns = [c.split(" ")[0] for c in schema.SOURCE_TABLES[table].split(", ")]
    text = ", ".join(f"coalesce(CAST({_CENTS.get(c, c)} AS VARCHAR), '')" for c in columns)
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, "
            f"CAST(sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT) AS BIGINT) AS checksum FROM {view}")


RESULTS["load_csv"] = " UNION ALL ".join(_checksum(t, v) for t, v in SOURCES.items())
RESULTS["load_counts"] = COUNTS
RESULTS["read_csv_subset"] = """SELECT campaign, t.description, household_key, start_day, end_day
FROM v_targets t JOIN v_campaign_desc USING (campaign)"""
RESULTS["read_table"] = f"SELECT household_key, day, {c('value_c', 'basket_value')} FROM v_trips"
PROMOS = "SELECT product_id, store_id, week_no, display, mailer, on_display, in_mailer FROM v_promos"
RESULTS["materialize"] = PROMOS

# ---------------------------------------------------------------- profile

RESULTS["profile_row_counts"] = COUNTS
_KEYS = [
    ("1. product: distinct product_id of rows", "v_product", "product_id"),
    ("2. hh_demographic: distinct household_key of rows", "v_demo", "household_key"),
    ("3. campaign_desc: distinct campaign of rows", "v_campaign_desc", "campaign"),
    ("4. campaign_table: distinct (household, campaign) of rows", "v_targets", "(household_key, campaign)"),
    ("5. coupon: distinct (coupon_upc, product_id, campaign) of rows", "v_coupon", "(coupon_upc, product_id, campaign)"),
    ("6. transactions: distinct (basket, product) of rows", "v_tx", "(basket_id, product_id)"),
    ("7. causal_data: distinct (product, store, week) of rows", "v_causal", "(product_id, store_id, week_no)"),
]
RESULTS["profile_key_uniqueness"] = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, count(DISTINCT {key}) || ' of ' || count(*) AS result FROM {view}"
    for name, view, key in _KEYS
)
RESULTS["profile_ranges"] = """
SELECT '8. transactions: day range / week range' AS check_name,
       min(day) || '-' || max(day) || ' / ' || min(week_no) || '-' || max(week_no) AS result FROM v_tx
UNION ALL SELECT '9. causal_data: week range', min(week_no) || '-' || max(week_no) FROM v_causal
UNION ALL SELECT '10. campaigns: first start day / last end day', min(start_day) || ' / ' || max(end_day) FROM v_campaign_desc"""
RESULTS["profile_coverage"] = """
SELECT '11. stores: in causal_data / in transactions' AS check_name,
       (SELECT count(DISTINCT store_id) FROM v_causal) || ' / ' || (SELECT count(DISTINCT store_id) FROM v_tx) AS result
UNION ALL SELECT '12. households: transactions / demographics / campaigns',
       (SELECT count(DISTINCT household_key) FROM v_tx) || ' / ' || (SELECT count(DISTINCT household_key) FROM v_demo)
       || ' / ' || (SELECT count(DISTINCT household_key) FROM v_targets)"""
RESULTS["profile_orphan_products"] = """SELECT '13. transaction rows whose product_id is missing from product' AS check_name, count(*) AS row_count
FROM v_tx ANTI JOIN v_product USING (product_id)"""
RESULTS["profile_orphan_coupons"] = """SELECT '14. redemptions whose coupon_upc is missing from coupon' AS check_name, count(*) AS row_count
FROM v_redempt ANTI JOIN v_coupon USING (coupon_upc)"""

# ---------------------------------------------------------------- quality

_CHECKS = {
    "dq_null_keys": ("count(*) FILTER (household_key IS NULL OR basket_id IS NULL OR product_id IS NULL OR store_id IS NULL "
                     "OR day IS NULL OR week_no IS NULL OR sales_c IS NULL)", "v_tx"),
    "dq_blank_category": ("count(*) FILTER (trim(coalesce(department, '')) = '' OR trim(coalesce(commodity_desc, '')) = '')",
                          "v_product"),
    "dq_placeholder_category": ("count(*) FILTER (commodity_desc = 'NO COMMODITY DESCRIPTION')", "v_product"),
    "dq_dup_coupon": ("count(*) - count(DISTINCT (coupon_upc, product_id, campaign))", "v_coupon"),
    "dq_dup_redempt": ("count(*) - count(DISTINCT (household_key, day, coupon_upc, campaign))", "v_redempt"),
    "dq_sales_sign": ("count(*) FILTER (sales_c = 0) || ' / ' || count(*) FILTER (sales_c < 0)", "v_tx"),
    "dq_quantity_sign": ("count(*) FILTER (quantity = 0) || ' / ' || count(*) FILTER (quantity < 0)", "v_tx"),
    "dq_positive_discounts": ("count(*) FILTER (retail_c > 0) || ' / ' || count(*) FILTER (coupon_c > 0) || ' / ' || "
                              "count(*) FILTER (match_c > 0)", "v_tx"),
    "dq_quantity_outlier": ("count(*) FILTER (quantity > 100) || ' / ' || max(quantity)", "v_tx"),
    "dq_sales_outlier": ("count(*) FILTER (sales_c > 10000) || ' / ' || CAST(max(sales_c) / 100 AS DECIMAL(10,2))", "v_tx"),
    "dq_week_span": ("count(*) FILTER (span > 6)", "(SELECT max(day) - min(day) AS span FROM v_tx GROUP BY week_no)"),
    "dq_bad_time": ("count(*) FILTER (trans_time < 0 OR trans_time > 2359 OR trans_time % 100 > 59)", "v_tx"),
    "dq_redempt_outside": ("count(*) FILTER (day NOT BETWEEN start_day AND end_day)",
                           "v_redempt JOIN v_campaign_desc USING (campaign)"),
    "dq_campaign_order": ("count(*) FILTER (end_day < start_day)", "v_campaign_desc"),
}
for _name, (_expr, _from) in _CHECKS.items():
    RESULTS[_name] = f"SELECT '{NAMES[_name].replace(chr(39), chr(39) * 2)}' AS check_name, CAST({_expr} AS VARCHAR) AS result FROM {_from}"
RESULTS["dq_report"] = " UNION ALL ".join(RESULTS[n] for n in _CHECKS)
RESULTS["dq_causal_conflicts"] = """
SELECT count(*) FILTER (n > 1) AS keys_with_repeats, count(*) FILTER (n > 1 AND v = 1) AS exact_copies,
       count(*) FILTER (v > 1) AS conflicting_placements
FROM (SELECT count(*) AS n, count(DISTINCT (display, mailer)) AS v FROM v_causal GROUP BY product_id, store_id, week_no)"""
RESULTS["dq_department_sales"] = f"""
SELECT department, count(DISTINCT product_id) AS products, count(*) AS rows,
       {d("round(sum(sales_c) / 100.0)", "sales")}, max(quantity) AS max_quantity,
       count(*) FILTER (sales_c <= 0) AS zero_or_neg_sales_rows, count(*) FILTER (retail_c > 0) AS positive_disc_rows
FROM v_tx JOIN v_product USING (product_id) GROUP BY department"""

# ---------------------------------------------------------------- clean layer

RESULTS["clean_transactions"] = f"""
SELECT household_key, basket_id, day, week_no, trans_time, store_id, product_id, department, commodity_desc,
       sub_commodity_desc, brand, quantity, {c("sales_c", "sales_value")}, {c("retail_c", "retail_disc")},
       {c("coupon_c", "coupon_disc")}, {c("match_c", "coupon_match_disc")} FROM v_lines"""
RESULTS["clean_promotions"] = PROMOS
RESULTS["promo_stores"] = "SELECT DISTINCT store_id FROM v_promos"
RESULTS["weekly_product_store_sales"] = f"""
SELECT product_id, store_id, week_no, department, commodity_desc, sub_commodity_desc, {i("units")},
       {c("sales_c", "sales")}, {c("disc_c", "discount")}, households, on_display, in_mailer, display, mailer,
       promo_tracked FROM v_weekly"""
CATEGORY_WEEK = f"""SELECT department, commodity_desc, week_no, {c("sales_c", "sales")}, {i("units")},
{c("disc_c", "discount")}, baskets, households FROM v_category"""
RESULTS["weekly_category_sales"] = CATEGORY_WEEK
RESULTS["fact_category_week"] = CATEGORY_WEEK
TRIPS = f"""SELECT basket_id, household_key, store_id, day, week_no, {c("value_c", "basket_value")}, {i("items")},
lines, {c("disc_c", "discount")}, used_coupon FROM v_trips"""
RESULTS["baskets"] = TRIPS
RESULTS["fact_baskets"] = TRIPS
RESULTS["households"] = f"""
SELECT household_key, first_day, last_day, trips, active_weeks, {c("sales_c", "sales")},
       {d("sales_c / 100.0 / trips", "avg_basket")}, {c("disc_c", "discount")}, campaigns_received, coupons_redeemed,
       has_demographics, age_desc, income_desc, marital_status_code, homeowner_desc, hh_comp_desc,
       household_size_desc, kid_category_desc FROM v_homes"""
RESULTS["clean_coupons"] = "SELECT DISTINCT coupon_upc, product_id, campaign FROM v_coupon"
RESULTS["campaigns"] = """SELECT campaign, campaign_type, start_day, end_day, end_day - start_day + 1 AS length_days,
households_targeted FROM v_campaigns"""


def _layer(name: str, view: str, cents: str) -> str:
    return (f"SELECT '{name}' AS layer, count(*) AS rows, {d(f'round(sum({cents}) / 100.0)', 'sales')}, "
            f"count(DISTINCT basket_id) AS baskets, count(DISTINCT household_key) AS households FROM {view}")


RESULTS["clean_reconciliation"] = f"""{_layer("1. raw transactions", "v_tx", "sales_c")}
UNION ALL {_layer("2. clean transactions", "v_lines", "sales_c")}
UNION ALL {_layer("3. clean baskets (rows should = baskets)", "v_trips", "value_c")}
UNION ALL SELECT '4. promotions: raw rows / clean rows / stores', (SELECT count(*) FROM v_causal), NULL,
          (SELECT count(*) FROM v_promos), (SELECT count(DISTINCT store_id) FROM v_promos)
UNION ALL SELECT '5. coupons: raw rows / clean rows', (SELECT count(*) FROM v_coupon), NULL,
          (SELECT count(*) FROM (SELECT DISTINCT * FROM v_coupon)), NULL"""

# ---------------------------------------------------------------- uplift

RESULTS["season_index"] = f"SELECT department, week_no, {d('season_idx')} FROM v_season"
RESULTS["ps_weeks"] = f"""SELECT product_id, store_id, week_no, department, commodity_desc, sub_commodity_desc,
{c("sales_c", "sales")}, {c("disc_c", "discount")}, {d("adj", "adj_sales")}, promoted FROM v_psweeks"""
RESULTS["ps_candidates"] = f"""SELECT product_id, store_id, department, commodity_desc, sub_commodity_desc,
{d("nonpromo", "nonpromo_sales")} FROM v_pairs WHERE sale_weeks >= 8"""
RESULTS["promo_weeks"] = "SELECT product_id, store_id, week_no, display, mailer, kind AS promo_type FROM v_promoweeks"
RESULTS["baseline"] = f"""SELECT product_id, store_id, department, commodity_desc, sub_commodity_desc, promo_weeks,
normal_weeks, {d("baseline", "baseline_weekly")} FROM v_base"""
RESULTS["promo_week_uplift"] = f"""
SELECT product_id, store_id, week_no, kind AS promo_type, display, mailer, department, commodity_desc,
       sub_commodity_desc, {d("actual", "actual_sales")}, {d("baseline", "baseline_weekly")},
       {d("extra", "incremental_sales")}, {c("disc_c", "discount")}, {d("after", "next_week_change")} FROM v_uplift"""
RESULTS["pull_forward"] = f"""SELECT product_id, store_id, week_no, {d("after", "next_week_change")}
FROM v_uplift WHERE after IS NOT NULL"""
_SUMMARY = ("baseline_sales", "actual_sales", "extra_sales", "uplift_pct", "avg_extra_per_week", "ci95",
            "after_promo_change", "net_extra_sales", "discount_given", "extra_per_discount_dollar")
RESULTS["uplift_summary"] = f"SELECT level, placement, promo_weeks, product_stores, {ds(*_SUMMARY)} FROM v_summary"
RESULTS["uplift_by_type_share"] = f"""
SELECT placement, promo_weeks, {ds("extra_sales", "uplift_pct", "avg_extra_per_week", "ci95",
"extra_per_discount_dollar")}, {d("extra_sales / sum(extra_sales) OVER ()", "share_of_extra")}
FROM v_summary WHERE level = '1. promo type'"""
RESULTS["uplift_additivity"] = f"""
SELECT {d("b", "both")}, {d("m", "mailer_only")}, {d("x", "display_only")}, {d("m + x", "sum_of_singles")},
       {d("b - (m + x)", "difference")}
FROM (SELECT any_value(avg_extra_per_week) FILTER (placement = 'display + mailer') AS b,
             any_value(avg_extra_per_week) FILTER (placement = 'mailer only') AS m,
             any_value(avg_extra_per_week) FILTER (placement = 'display only') AS x
      FROM v_summary WHERE level = '1. promo type')"""
RESULTS["placement_labels"] = f"""SELECT level, placement, position, prefix || position AS name, promo_weeks,
{ds("extra_sales", "avg_extra_per_week", "ci95", "extra_per_discount_dollar")} FROM v_labels"""
RESULTS["placement_highlights"] = f"""
SELECT {d("any_value(avg_extra_per_week) FILTER (mail AND placement = 'D') / any_value(avg_extra_per_week) FILTER (mail AND placement = 'A')", "front_to_interior")},
       {d("any_value(promo_weeks) FILTER (mail AND placement = 'A') / sum(promo_weeks) FILTER (mail)", "interior_share")},
       count(*) FILTER (level LIKE '2.%') AS display_locations,
       {d("min(avg_extra_per_week) FILTER (level LIKE '2.%')", "display_min")},
       {d("max(avg_extra_per_week) FILTER (level LIKE '2.%')", "display_max")}
FROM (SELECT *, level LIKE '3.%' AS mail FROM v_labels)"""
RESULTS["placebo_test"] = f"""SELECT CAST(seed AS INTEGER) AS seed, product_stores, fake_weeks,
{d("fake_extra", "fake_extra_per_week")}, {d("ci", "ci95")}, abs(fake_extra) <= ci AS range_includes_zero FROM v_placebo"""
RESULTS["placebo_summary"] = f"""SELECT count(*) AS runs, {d("avg(fake_extra)", "mean_fake_extra")},
{d("min(fake_extra)", "min_fake_extra")}, {d("max(fake_extra)", "max_fake_extra")},
count(*) FILTER (abs(fake_extra) <= ci) AS ranges_with_zero FROM v_placebo"""

# ---------------------------------------------------------------- cannibalisation

RESULTS["ps_all_baseline"] = f"""SELECT product_id, store_id, department, sub_commodity_desc,
{d("nonpromo", "nonpromo_sales")}, promo_weeks, {d("baseline", "baseline_weekly")} FROM v_allbase"""
RESULTS["promoted_product_weeks"] = f"""SELECT product_id, store_id, week_no, department, sub_commodity_desc,
kind AS promo_type, {d("extra")} FROM v_promoted"""
RESULTS["subcat_weeks"] = f"""SELECT department, sub_commodity_desc, store_id, week_no, {d("total_sales")}, promo_week,
{d("promoted_extra")}, products AS promoted_products, kinds AS promo_type FROM v_subweeks"""
RESULTS["subcat_baseline"] = f"""SELECT department, sub_commodity_desc, store_id, promo_weeks,
93 - promo_weeks AS normal_weeks, {d("baseline", "baseline_weekly")} FROM v_subbase"""
_CANNIBAL = ("promoted_extra", "category_extra", "taken_from_similar", "taken_ci95", "cannibalised_pct")
CANNIBAL = f"""SELECT level, grp, subcat_store_weeks, subcat_stores, {ds(*_CANNIBAL, "coverage_pct")} FROM v_cannibal"""
RESULTS["cannibalisation_summary"] = CANNIBAL
RESULTS["cannibalisation_report"] = f"{CANNIBAL} WHERE level <> '3. department' OR subcat_stores >= 30"
RESULTS["cannibalised_share"] = f"""
SELECT level, grp, {ds("promoted_extra", "category_extra", "taken_from_similar", "taken_ci95", "coverage_pct")},
       {d("taken_from_similar / nullif(promoted_extra, 0)", "cannibalised_share")},
       {d("taken_ci95 / nullif(abs(promoted_extra), 0)", "share_ci95")},
       abs(taken_from_similar) > taken_ci95 AS clear_effect
FROM v_cannibal WHERE level <> '3. department'"""
RESULTS["cannibalised_by_department"] = f"""
SELECT grp AS department, subcat_stores, {ds("promoted_extra", "taken_from_similar", "taken_ci95", "cannibalised_pct")},
       {d("CASE WHEN abs(taken_from_similar) > taken_ci95 THEN cannibalised_pct END", "cannibalised_pct_clear")}
FROM v_cannibal WHERE level = '3. department' AND subcat_stores >= 32"""

# ---------------------------------------------------------------- campaigns

RESULTS["never_targeted"] = "SELECT DISTINCT household_key FROM v_trips ANTI JOIN v_targets USING (household_key)"
RESULTS["campaign_reach_response"] = f"""SELECT campaign, campaign_type, start_day, end_day, households_targeted,
households_redeemed, {d("length_weeks")} FROM v_reach"""
RESULTS["campaign_overview"] = f"""SELECT campaign_type, campaigns, households_targeted, households_redeemed,
{ds("avg_households", "avg_length_weeks", "response_rate")} FROM v_overview"""
_WINDOWS = {"history": (1, 111), "earlier": (112, 167), "before": (168, 223), "during": (224, 263)}
RESULTS["window_spend"] = "SELECT household_key, " + ", ".join(
    d(f"coalesce(sum(value_c) FILTER (day BETWEEN {a} AND {b}), 0) / 100.0 / ({b - a + 1} / 7.0)", n)
    for n, (a, b) in _WINDOWS.items()
) + " FROM v_trips GROUP BY household_key"
for _name, _view in (("did_panel_never", "v_panel_never"), ("did_panel_other_times", "v_panel_other")):
    RESULTS[_name] = f"""SELECT campaign, campaign_type, treated, household_key, {ds("weeks", "history", "earlier",
"before", "during")}, spend_decile, {d("during - before", "change")}, {d("before - earlier", "pre_change")} FROM {_view}"""
RESULTS["spend_decile"] = "SELECT campaign, household_key, spend_decile FROM v_panel_never"
# Two-sided p-value: the density of t is proportional to cos(angle) ^ (dof - 1) with tan(angle) = t / sqrt(dof);
# integrated with Simpson's rule.
RESULTS["did_per_campaign"] = f"""
WITH s AS (
  SELECT campaign, campaign_type, count(*) FILTER (treated = 1) AS n1, count(*) FILTER (treated = 0) AS n0,
         avg(before) FILTER (treated = 1) AS b1, avg(before) FILTER (treated = 0) AS b0,
         avg(during - before) FILTER (treated = 1) AS m1, avg(during - before) FILTER (treated = 0) AS m0,
         var_samp(during - before) FILTER (treated = 1) AS v1, var_samp(during - before) FILTER (treated = 0) AS v0
  FROM v_panel_never GROUP BY ALL
),
t AS (
  SELECT *, (m1 - m0) / nullif(sqrt(v1 / n1 + v0 / n0), 0) AS t,
         (v1 / n1 + v0 / n0) ** 2
           / nullif((v1 / n1) ** 2 / nullif(n1 - 1, 0) + (v0 / n0) ** 2 / nullif(n0 - 1, 0), 0) AS nu
  FROM s
),
p AS (
  SELECT campaign, 1 - 2 * sum(CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
           * cos(atan(abs(t) / sqrt(nu)) * k / 2000) ** (nu - 1)) * any_value(atan(abs(t) / sqrt(nu))) / 6000
         / any_value(exp(lgamma(nu / 2) - lgamma((nu + 1) / 2)) * sqrt(pi())) AS p
  FROM t CROSS JOIN (SELECT unnest(range(0, 2001)) AS k) WHERE t IS NOT NULL AND nu IS NOT NULL GROUP BY campaign
)
SELECT campaign, campaign_type, n1 AS targeted, n0 AS comparison, {d("b1", "before_targeted")},
       {d("b0", "before_comparison")}, {d("m1 - m0", "did_per_week")}, {d("t", "t_value")}, {d("nu", "dof")},
       {d("p", "p_value")}
FROM t LEFT JOIN p USING (campaign)"""
_EFFECT = ("effect_per_week", "ci95_low", "ci95_high", "p_value")
RESULTS["did_by_type"] = f"""SELECT campaign_type, campaigns, targeted_households,
{ds(*_EFFECT, "effect_pct_of_spend", "total_extra_sales")} FROM v_did_never"""
RESULTS["pretrend_by_type"] = f"""SELECT campaign_type, {d("effect_per_week", "pre_trend_per_week")},
{ds("ci95_low", "ci95_high", "p_value")} FROM v_pre_never"""
RESULTS["did_summary"] = f"""
SELECT campaign_type, {d("a.effect_per_week", "effect_never")}, {d("a.p_value", "p_never")}, {d("b.p_value", "pre_trend_p_never")},
       {d("c.effect_per_week", "effect_other_times")}, {d("c.p_value", "p_other_times")}, {d("e.p_value", "pre_trend_p_other_times")}
FROM v_did_never a FULL JOIN v_pre_never b USING (campaign_type) FULL JOIN v_did_other c USING (campaign_type)
FULL JOIN v_pre_other e USING (campaign_type)"""
RESULTS["campaign_results"] = f"""
WITH both_designs AS (
  SELECT a.*, b.p_value AS pre_p, 'Never targeted' AS comparison FROM v_did_never a LEFT JOIN v_pre_never b USING (campaign_type)
  UNION ALL
  SELECT a.*, b.p_value, 'Targeted at other times' FROM v_did_other a LEFT JOIN v_pre_other b USING (campaign_type)
)
SELECT campaign_type, x.campaigns, targeted_households, {ds(*_EFFECT, "effect_pct_of_spend", "total_extra_sales")},
       {d("pre_p", "pre_trend_p")}, comparison, o.campaigns AS campaigns_sent, o.households_targeted, o.households_redeemed,
       {d("o.response_rate", "response_rate")}, pre_p > 0.05 AS passes_pre_trend
FROM both_designs x JOIN v_overview o USING (campaign_type)"""
RESULTS["bi_campaign_results"] = RESULTS["campaign_results"]
RESULTS["event_study"] = f"""
WITH n AS (SELECT campaign, any_value(campaign_type) AS campaign_type, count(*) FILTER (treated = 1) AS n1,
                  count(*) FILTER (treated = 0) AS n0 FROM v_panel_never GROUP BY campaign),
spent AS (
  SELECT m.campaign, CAST(floor((t.day - g.start_day) / 7.0) AS INTEGER) AS rel_week,
         sum(t.value_c) FILTER (m.treated = 1) AS s1, sum(t.value_c) FILTER (m.treated = 0) AS s0
  FROM v_panel_never m JOIN v_campaigns g USING (campaign) JOIN v_trips t USING (household_key)
  WHERE floor((t.day - g.start_day) / 7.0) BETWEEN -8 AND 8 GROUP BY ALL
),
gaps AS (
  SELECT n.*, w.rel_week, coalesce(s1, 0) / 100.0 / nullif(n1, 0) - coalesce(s0, 0) / 100.0 / nullif(n0, 0) AS gap
  FROM n CROSS JOIN (SELECT CAST(unnest(range(-8, 9)) AS INTEGER) AS rel_week) w
  LEFT JOIN spent USING (campaign, rel_week)
),
centred AS (SELECT *, gap - avg(gap) FILTER (rel_week < 0) OVER (PARTITION BY campaign) AS g FROM gaps)
SELECT campaign_type, rel_week, {d("sum(g * n1) / sum(n1)", "gap")} FROM centred GROUP BY ALL"""

# ---------------------------------------------------------------- segments

RESULTS["rfm_base"] = f"SELECT household_key, days_since_last, trips, {c('sales_c', 'sales')} FROM v_scores"
RESULTS["trip_gaps"] = "SELECT household_key, day, gap FROM v_gaps"
RESULTS["gap_stats"] = f"SELECT household_key, {ds('median_gap', 'p90_gap')} FROM v_gapstats"
RESULTS["recent_13w"] = f"""SELECT household_key, {c("last_c", "last_13w_sales")}, {c("prev_c", "prev_13w_sales")}
FROM v_recent"""
_SCORES = "CAST(r_score AS INTEGER) AS r_score, CAST(f_score AS INTEGER) AS f_score, CAST(m_score AS INTEGER) AS m_score"
RESULTS["rfm_scores"] = f"SELECT household_key, days_since_last, trips, {c('sales_c', 'sales')}, {_SCORES} FROM v_scores"
RESULTS["household_rfm"] = f"""SELECT household_key, days_since_last, trips, {c("sales_c", "sales")}, {_SCORES}, segment,
{ds("median_gap", "p90_gap")}, {c("last_c", "last_13w_sales")}, {c("prev_c", "prev_13w_sales")}, gone_quiet, fading
FROM v_rfm"""
RESULTS["rfm_segment_summary"] = f"""
SELECT segment, count(*) AS households, {d("round(100.0 * count(*) / sum(count(*)) OVER (), 1)", "pct_households")},
       {d("round(100.0 * sum(sales_c) / sum(sum(sales_c)) OVER (), 1)", "pct_sales")},
       {d("round(avg(days_since_last))", "avg_days_since_last")}, {d("round(avg(trips))", "avg_trips")},
       {d("round(avg(sales_c) / 100.0)", "avg_sales")}, count(*) FILTER (gone_quiet) AS gone_quiet, count(*) FILTER (fading) AS fading
FROM v_rfm GROUP BY segment"""
RESULTS["churn_flags"] = " UNION ALL ".join(
    f"SELECT '{n}' AS flag, count(*) FILTER ({f}) AS households, "
    f"{d(f'coalesce(sum(prev_c) FILTER ({f}), 0) / 100.0', 'sales_at_risk_per_13w')}, "
    f"{d(f'count(*) FILTER ({f}) / count(*)', 'pct_households')} FROM v_rfm"
    for n, f in (("gone quiet", "gone_quiet"), ("fading", "fading"), ("either", "gone_quiet OR fading"))
)
RESULTS["churn_backtest"] = f"""SELECT CASE WHEN flagged THEN 'flagged at day 620' ELSE 'not flagged' END AS churn_group,
flagged, households, {d("came_back")}, {d("1 - came_back", "did_not_come_back")} FROM v_backtest"""
RESULTS["churn_backtest_ratio"] = f"""SELECT {d("a", "flagged_rate")}, {d("b", "unflagged_rate")},
{d("a / greatest(b, 1e-9)", "times_likelier")}
FROM (SELECT any_value(1 - came_back) FILTER (flagged) AS a, any_value(1 - came_back) FILTER (NOT flagged) AS b
      FROM v_backtest)"""


def _retention(by: str, source: str) -> str:
    lead = f"{by}, " if by else ""
    also = f"AND b.{by} = a.{by}" if by else ""
    return f"""
WITH q AS (SELECT DISTINCT household_key, {lead}CAST((day - 1) // 91 + 1 AS INTEGER) AS quarter FROM {source}),
n AS (SELECT {lead.replace(by, "a." + by) if by else ""}a.quarter, count(*) AS active, count(b.household_key) AS stayed
      FROM q a LEFT JOIN q b ON b.household_key = a.household_key AND b.quarter = a.quarter + 1 {also} GROUP BY ALL),
r AS (SELECT {lead.replace(by, "a." + by) if by else ""}a.quarter, active,
             CASE WHEN EXISTS (SELECT 1 FROM n b WHERE b.quarter = a.quarter + 1 {also}) THEN stayed END AS stayed FROM n a)
SELECT {lead}quarter, active AS active_households, stayed AS still_active_next_quarter,
       {d("stayed / active", "retention_rate")} FROM r"""


RESULTS["retention_by_quarter"] = _retention("", "v_trips")
RESULTS["kpi_responder_retention"] = _retention(
    "redeemed", "(SELECT *, household_key IN (SELECT household_key FROM v_redempt) AS redeemed FROM v_trips)")
RESULTS["redemption_by"] = f"""
SELECT grouping, value, n AS households, x AS redeemed, {d("x / n", "rate")},
       {d("(x + zz / 2) / (n + zz) - sqrt(zz) / (n + zz) * sqrt(x * (n - x) / n + zz / 4)", "ci_low")},
       {d("(x + zz / 2) / (n + zz) + sqrt(zz) / (n + zz) * sqrt(x * (n - x) / n + zz / 4)", "ci_high")}
FROM (SELECT *, CAST(1.959963984540054 AS DOUBLE) ** 2 AS zz FROM v_rates)"""
# Upper tail of the chi-square density, integrated with Simpson's rule over 400 beyond the statistic.
RESULTS["redemption_chi_square"] = f"""
WITH m AS (SELECT grouping, sum(n) AS n, sum(x) AS x, count(*) AS k FROM v_rates WHERE grouping <> 'overall' GROUP BY 1),
cells AS (
  SELECT r.grouping, m.k, abs(r.x - r.n * m.x / m.n) AS off, r.n * m.x / m.n AS e1, r.n * (m.n - m.x) / m.n AS e0
  FROM v_rates r JOIN m USING (grouping)
),
s AS (
  SELECT grouping, any_value(k) - 1 AS dof,
         sum((CASE WHEN k = 2 THEN off - least(0.5, off) ELSE off END) ** 2 * (1 / e1 + 1 / e0)) AS chi
  FROM cells GROUP BY 1
),
p AS (
  SELECT grouping, sum(CASE WHEN i IN (0, 40000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
           * (chi + i / 100) ** (dof / 2 - 1) * exp(-(chi + i / 100) / 2)) / 300
         / any_value(2 ** (dof / 2) * gamma(dof / 2)) AS p
  FROM s CROSS JOIN (SELECT unnest(range(0, 40001)) AS i) GROUP BY 1
)
SELECT grouping, {d("chi", "chi_square")}, dof, {d("p", "p_value")} FROM s JOIN p USING (grouping)"""
RESULTS["income_band"] = """SELECT household_key, income_desc, income_band
FROM v_homes LEFT JOIN v_bands USING (income_desc) WHERE has_demographics"""

# ---------------------------------------------------------------- dashboards

RESULTS["dim_week"] = """
SELECT week_no, CASE WHEN week_no <= 52 THEN 1 ELSE 2 END AS year_no, (week_no - 1) % 52 + 1 AS week_of_year,
       'Q' || ((week_no - 1) // 13 + 1) AS quarter_label, days_with_data, days_with_data >= 7 AS complete_week
FROM v_week"""
_KNOWN = ", ".join(f"coalesce({n}, 'Not known') AS {n}" for n in ("age_desc", "hh_comp_desc", "homeowner_desc"))
RESULTS["dim_household"] = f"""
SELECT household_key, segment, {_SCORES}, days_since_last, trips, {c("sales_c", "sales")}, gone_quiet, fading, churn_risk,
       {c("last_c", "last_13w_sales")}, {c("prev_c", "prev_13w_sales")}, campaigns_received, coupons_redeemed,
       campaigns_received > 0 AS targeted, coupons_redeemed > 0 AS redeemed, has_demographics, {_KNOWN},
       CASE WHEN income_desc IS NULL THEN 'Not known' ELSE coalesce(b.income_band, '$125K+') END AS income_band
FROM v_dimhome LEFT JOIN v_bands b USING (income_desc)"""
RESULTS["bi_promo_uplift"] = f"""
SELECT CASE level WHEN '{schema.LEVEL_TYPE}' THEN 'Promotion type' WHEN '{schema.LEVEL_DISPLAY}' THEN 'Display location'
                  ELSE 'Mailer placement' END AS level,
       coalesce(n.position, s.placement) AS placement, promo_weeks, {ds("extra_sales", "uplift_pct", "avg_extra_per_week",
       "ci95")}, {d("avg_extra_per_week - ci95", "ci_low")}, {d("avg_extra_per_week + ci95", "ci_high")},
       {ds("net_extra_sales", "discount_given", "extra_per_discount_dollar")}
FROM v_summary s LEFT JOIN v_names n USING (level, placement)
WHERE NOT (level = '{schema.LEVEL_MAILER}' AND s.placement IN ({FREE_ITEMS}))"""
RESULTS["bi_promo_cannibalisation"] = f"""SELECT grp AS promo_type, {ds(*_CANNIBAL)}
FROM v_cannibal WHERE level = '2. promo type'"""

# ---------------------------------------------------------------- weekly report

RESULTS["latest_complete_week"] = "SELECT w AS week_no FROM v_reportweek"


def _pct(new: str, old: str) -> str:
    return f"{new} / nullif({old}, 0) - 1"


_COMPARE = (f"{d('this', 'sales_this_week')}, {d('last', 'sales_last_week')}, {d('avg4', 'avg_last_4_weeks')}, "
            f"{d('year_ago', 'same_week_last_year')}, {d(_pct('this', 'last'), 'vs_last_week')}, "
            f"{d(_pct('this', 'avg4'), 'vs_4_week_avg')}, {d(_pct('this', 'year_ago'), 'vs_last_year')}, "
            f"{d('this / nullif(sum(this) OVER (), 0)', 'share_of_sales')}")
RESULTS["weekly_category_report"] = f"""SELECT department, category, {_COMPARE},
{d("CASE WHEN this > 0 THEN disc / this END", "discount_pct")} FROM v_categories"""
RESULTS["weekly_department_report"] = f"""SELECT department, {_COMPARE}
FROM (SELECT department, sum(this) AS this, sum(last) AS last, sum(avg4) AS avg4, sum(year_ago) AS year_ago
      FROM v_categories GROUP BY department)"""
RESULTS["weekly_headline"] = f"""
WITH k AS (
  SELECT sum(value_c) FILTER (week_no = w) / 100.0 AS s0, sum(value_c) FILTER (week_no = w - 1) / 100.0 AS s1,
         count(DISTINCT household_key) FILTER (week_no = w) AS h0,
         count(DISTINCT household_key) FILTER (week_no = w - 1) AS h1,
         count(*) FILTER (week_no = w) AS t0, count(*) FILTER (week_no = w - 1) AS t1
  FROM v_trips CROSS JOIN v_reportweek
),
m AS (
  SELECT 'Sales' AS metric, coalesce(s0, 0) AS a, coalesce(s1, 0) AS b FROM k
  UNION ALL SELECT 'Households', h0, h1 FROM k
  UNION ALL SELECT 'Trips', t0, t1 FROM k
  UNION ALL SELECT 'Basket value', coalesce(s0 / nullif(t0, 0), 0), coalesce(s1 / nullif(t1, 0), 0) FROM k
)
SELECT metric, {d("a", "this_week")}, {d("b", "last_week")}, {d(_pct("a", "b"), "change")} FROM m"""
_MOVERS = f"""SELECT department, category, {d("this", "sales_this_week")}, {d("avg4", "avg_last_4_weeks")},
{d("this - avg4", "change_vs_4_week_avg")}, {d(_pct("this", "avg4"), "vs_4_week_avg")}, direction"""
RESULTS["weekly_movers"] = f"""{_MOVERS} FROM (
  (SELECT *, 'rising' AS direction FROM v_categories WHERE avg4 >= 100 AND this > avg4
   ORDER BY this - avg4 DESC, department, category LIMIT 10)
  UNION ALL
  (SELECT *, 'falling' FROM v_categories WHERE avg4 >= 100 AND this < avg4
   ORDER BY this - avg4, department, category LIMIT 10))"""

# ---------------------------------------------------------------- KPI trees

_TREE = """(SELECT sum(sales_c) / 100.0 AS sales, count(DISTINCT household_key) AS households,
count(DISTINCT basket_id) AS trips, count(DISTINCT store_id) AS stores, min(day) AS first_day, max(day) AS last_day,
min(week_no) AS first_week, max(week_no) AS last_week, count(*) AS n FROM v_tx)"""
RESULTS["kpi_sales_tree"] = f"""SELECT {d("sales")}, households, trips, stores, first_day, last_day, first_week,
last_week, {d("trips / households", "trips_per_household")}, {d("sales / trips", "spend_per_trip")} FROM {_TREE}"""
RESULTS["kpi_rebuild_check"] = f"""SELECT {d("sales")}, {d("households * (trips / households) * (sales / trips)",
"rebuilt")}, TRUE AS matches FROM {_TREE}"""
RESULTS["kpi_items_per_trip"] = f"""SELECT n AS purchase_lines, trips, {d("n / trips", "items_per_trip")},
{d("sales / n", "spend_per_item")} FROM {_TREE}"""
RESULTS["kpi_discounts"] = f"""
SELECT {d("sum(abs(retail_c)) / 100.0", "retail_discount")}, {d("sum(abs(coupon_c)) / 100.0", "coupon_discount")},
       {d("(sum(abs(retail_c)) + sum(abs(coupon_c))) / sum(sales_c)", "discount_share")},
       {d("count(*) FILTER (retail_c <> 0 OR coupon_c <> 0) / count(*)", "discounted_lines")} FROM v_tx"""
RESULTS["kpi_discount_describe"] = " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count({x}) AS count, {d(f'avg({x} / 100.0)', 'mean')}, "
    f"{d(f'stddev_samp({x} / 100.0)', 'std')}, {d(f'min({x}) / 100.0', 'min')}, {d(f'max({x}) / 100.0', 'max')}, "
    + ", ".join(d(f"quantile_cont(CAST({x} AS DOUBLE), {q}) / 100.0", f"p{q * 100:.0f}") for q in (0.25, 0.5, 0.75))
    + " FROM v_tx"
    for n, x in (("retail_disc", "retail_c"), ("coupon_disc", "coupon_c"))
)
RESULTS["kpi_campaign_reach"] = f"""
SELECT description, count(*) AS campaigns, (SELECT count(DISTINCT household_key) FROM v_tx) AS households,
       (SELECT count(DISTINCT household_key) FROM v_targets) AS households_reached,
       (SELECT count(DISTINCT household_key) FROM v_demo) AS households_described,
       {d("(SELECT count(DISTINCT household_key) FROM v_targets) / (SELECT count(DISTINCT household_key) FROM v_tx)", "reach")}
FROM v_campaign_desc GROUP BY description"""
_WEEKLY = "(SELECT week_no, sum(value_c) / 100.0 AS sales FROM v_trips GROUP BY week_no)"
RESULTS["kpi_rolling_4w"] = f"""SELECT week_no, {d("sales")}, {d('''sum(sales) OVER (ORDER BY week_no
RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)''', "rolling_4w_sales")} FROM {_WEEKLY}"""
RESULTS["kpi_wow"] = f"""SELECT a.week_no, {d("a.sales", "sales")}, {d("b.sales", "last_week")},
{d(_pct("a.sales", "b.sales"), "change")} FROM {_WEEKLY} a LEFT JOIN {_WEEKLY} b ON b.week_no = a.week_no - 1"""
RESULTS["kpi_net_extra"] = f"""
SELECT promo_type, {ds("extra_sales", "after_promo_change", "discount_given", "taken_from_similar")},
       {d("net", "net_extra")}, {d("net / nullif(discount_given, 0)", "net_extra_per_discount_dollar")}
FROM (SELECT s.placement AS promo_type, extra_sales, coalesce(after_promo_change, 0) AS after_promo_change, discount_given,
             taken_from_similar, extra_sales + coalesce(after_promo_change, 0) - coalesce(taken_from_similar, 0) AS net
      FROM v_summary s LEFT JOIN v_cannibal c ON c.level = '2. promo type' AND c.grp = s.placement
      WHERE s.level = '1. promo type')"""

# ---------------------------------------------------------------- recommendations and the coupon test

RESULTS["promo_type_economics"] = f"""SELECT placement, promo_weeks, {d("avg_extra_per_week")},
{d("disc_week", "discount_per_week")}, {d("cannibalised_pct")}, {d("net_week", "net_extra_per_week")} FROM v_econ"""
RESULTS["rec_display_on_mailer"] = f"""
SELECT {d("share", "share_of_mailer_weeks")}, {d("weeks", "weeks_converted")}, {d("gain", "gain_per_week")},
       {d("cost", "discount_per_week")}, {d("weeks * gain", "extra_sales")}, {d("weeks * cost", "extra_discount")},
       {d("weeks / display_weeks", "more_display_weeks")},
       {d("(weeks * gain) / nullif(weeks * cost, 0)", "extra_sales_per_discount_dollar")},
       {d("weeks * gain / 2 / homes * 1000", "extra_sales_per_1000_hh_yr")} FROM v_display"""
RESULTS["rec_slot_upgrade"] = f"""
SELECT {d("s", "extra_sales_per_week")}, {d("x", "extra_discount_per_week")},
       {d("s / nullif(x, 0)", "sales_per_discount_dollar")}
FROM (SELECT any_value(avg_extra_per_week) FILTER (placement = 'D') - any_value(avg_extra_per_week) FILTER (placement = 'A') AS s,
             any_value(discount_given / promo_weeks) FILTER (placement = 'D')
               - any_value(discount_given / promo_weeks) FILTER (placement = 'A') AS x
      FROM v_summary WHERE level LIKE '3.%')"""
RESULTS["rec_cut_departments"] = f"""SELECT department, promo_weeks, {ds("extra_sales", "discount_given",
"promoted_extra", "taken_from_similar", "taken_ci95", "cannibalised_pct", "net_extra")},
{d("net_extra / nullif(discount_given, 0)", "net_extra_per_discount_dollar")} FROM v_cuts"""
RESULTS["avg_coupon_value"] = f"SELECT n AS coupon_lines, {d('avg_coupon')} FROM v_coupons_used"
RESULTS["rec_at_risk_value"] = f"""
SELECT {d("share", "share_of_leavers_saved")}, at_risk AS at_risk_households, {d("yearly", "at_risk_sales_per_year")},
       {d("stake", "sales_at_stake_per_year")}, {d("cost", "coupon_cost_per_year")},
       {d("cost / nullif(stake, 0)", "break_even_share")}, {d("share * stake", "sales_kept_per_year")},
       {d("share * stake / homes * 1000", "sales_kept_per_1000_hh_yr")}
FROM v_stake CROSS JOIN (SELECT unnest([0.1, 0.2, 0.3]) AS share)"""
RESULTS["rec_summary"] = f"""
WITH parts AS (
  SELECT '1. display on mailer items' AS recommendation, weeks * gain / 2 AS s, weeks * cost / 2 AS x
  FROM v_display WHERE share = 0.2
  UNION ALL SELECT '2. cut cannibalising promotions', -coalesce(sum(net_extra), 0) / 2,
                   -coalesce(sum(discount_given), 0) / 2 FROM v_cuts
  UNION ALL SELECT '3. coupons to at-risk households', 0.2 * stake, 0 FROM v_stake
)
SELECT recommendation, {d("s", "extra_sales_per_year")}, {d("x", "extra_discount_per_year")},
       {d("s / homes * 1000", "extra_sales_per_1000_hh_yr")}, {d("x / homes * 1000", "discount_change_per_1000_hh_yr")}
FROM parts CROSS JOIN (SELECT count(*) AS homes FROM v_dimhome)"""
RESULTS["ab_pool_stats"] = f"""SELECT pool, n AS households, {d("mean", "mean_weekly_spend")}, {d("sd", "sd_weekly_spend")}
FROM v_poolstats"""
RESULTS["ab_sample_size"] = f"""
SELECT pool, {d("lift", "lift_to_detect")}, {d("lift * mean", "lift_dollars_per_week")}, g AS households_per_group,
       2 * g AS total_households
FROM (SELECT *, CAST(ceil(2 * ((1.959963984540054::DOUBLE + 0.8416212335729143::DOUBLE) * sd / nullif(lift * mean, 0)) ** 2)
             AS BIGINT) AS g
      FROM v_poolstats CROSS JOIN (SELECT unnest([0.05, 0.1, 0.15, 0.2]::DOUBLE[]) AS lift))"""
# Power of the t test at the sizes from the normal form upwards. The normal distribution function is its series; the critical value is the
# expansion of Student's t around the normal value; the estimated over the true deviation (1 + o) is summed over a grid.
_NORMAL_UP_TO = ("(0.5 + exp(-0.5 * ({0}) ** 2) / sqrt(2 * pi()) * list_sum(list_transform(range(100), lambda k: "
                 "({0}) ** (2 * k + 1) / exp(lgamma(2 * k + 2) - k * ln(2) - lgamma(k + 1)))))")
RESULTS["ab_sample_size_exact"] = f"""
WITH wanted AS (
  SELECT pool, lift, lift * mean / nullif(sd, 0) AS effect
  FROM v_poolstats CROSS JOIN (SELECT unnest([0.05, 0.1, 0.15, 0.2]::DOUBLE[]) AS lift)),
sizes AS (
  SELECT pool, lift, effect, n::DOUBLE AS n, 2 * n::DOUBLE - 2 AS nu, 1.959963984540054::DOUBLE AS z
  FROM (SELECT *, unnest(range(greatest(2, ceil(15.697759 / effect ** 2)::BIGINT - 1), ceil(15.697759 / effect ** 2)::BIGINT + 6)) AS n
        FROM wanted WHERE effect <> 0)),
bounds AS (
  SELECT *, effect * sqrt(n / 2) AS delta, z + (z**3 + z) / (4 * nu) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * nu**2)
    + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / (384 * nu**3)
    + (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / (92160 * nu**4) AS bound
  FROM sizes),
grid AS (SELECT *, unnest(range(-200, 201)) / 25.0::DOUBLE / sqrt(2 * nu) AS o FROM bounds),
summed AS (
  SELECT pool, lift, n, sum(w * ({_NORMAL_UP_TO.format("delta - bound * (1 + o)")} + {_NORMAL_UP_TO.format("-delta - bound * (1 + o)")})) / sum(w) AS power
  FROM (SELECT *, exp((nu - 1) * ln(1 + o) - nu * o * (2 + o) / 2) AS w FROM grid WHERE o > -1) GROUP BY ALL)
SELECT pool, {d("lift", "lift_to_detect")}, g::BIGINT AS households_per_group, 2 * g::BIGINT AS total_households
FROM wanted LEFT JOIN (SELECT pool, lift, min(n) AS g FROM summed WHERE power >= 0.8 GROUP BY ALL) USING (pool, lift)"""
RESULTS["ab_sample_size_prop"] = f"""
SELECT {d("a", "keep_rate")}, {d("b", "target_rate")}, {d("h", "effect_size")},
       CAST(ceil(2 * ((1.959963984540054::DOUBLE + 0.8416212335729143::DOUBLE) / nullif(h, 0)) ** 2) AS BIGINT)
         AS households_per_group
FROM (SELECT *, 2 * asin(sqrt(b)) - 2 * asin(sqrt(a)) AS h
      FROM (SELECT came_back AS a, least(came_back + 0.05, 1) AS b FROM v_backtest WHERE flagged))"""
RESULTS["ab_assignment"] = "SELECT household_key, segment, arm FROM v_arms"
RESULTS["ab_balance"] = f"""
SELECT segment, arm, count(*) AS households, {d("coalesce(sum(spend_c), 0) / (800.0 * count(*))::DOUBLE", "mean_weekly_spend")},
       {d("coalesce(sum(trips), 0) / (8.0 * count(*))::DOUBLE", "mean_weekly_trips")},
       {d("count(*) / sum(count(*)) OVER (PARTITION BY segment)", "share_of_segment")}
FROM v_arms LEFT JOIN (SELECT household_key, sum(value_c) AS spend_c, count(*) AS trips FROM v_trips
                       WHERE week_no BETWEEN 94 AND 101 GROUP BY 1) USING (household_key)
GROUP BY segment, arm"""
RESULTS["ab_readout"] = f"""
WITH s AS (
  SELECT arm = 'test' AS t, coalesce(w.spend, 0) AS spend, coalesce(k.coupons, 0) AS coupons,
         household_key IN (SELECT household_key FROM v_trips WHERE week_no BETWEEN 98 AND 101) AS later
  FROM v_arms
  LEFT JOIN (SELECT household_key, sum(value_c) / 800.0 AS spend FROM v_trips
             WHERE week_no BETWEEN 90 AND 97 GROUP BY 1) w USING (household_key)
  LEFT JOIN (SELECT household_key, sum(coupon_c + match_c) / 100.0 AS coupons FROM v_lines
             WHERE week_no BETWEEN 90 AND 97 GROUP BY 1) k USING (household_key)
),
m AS (
  SELECT count(*) FILTER (t) AS n1, count(*) FILTER (NOT t) AS n0, avg(spend) FILTER (t) AS m1, avg(spend) FILTER (NOT t) AS m0,
         1.959963984540054::DOUBLE * sqrt(var_samp(spend) FILTER (t) / count(*) FILTER (t)
           + var_samp(spend) FILTER (NOT t) / count(*) FILTER (NOT t)) AS half,
         count(*) FILTER (t AND later) / count(*) FILTER (t) AS l1, count(*) FILTER (NOT t AND later) / count(*) FILTER (NOT t) AS l0,
         sum(coupons) FILTER (t) / count(*) FILTER (t) / 8 AS cost
  FROM s
)
SELECT n1 AS test_households, n0 AS control_households, {d("m1", "test_weekly_spend")}, {d("m0", "control_weekly_spend")},
       {d("m1 - m0", "difference")}, {d("m1 - m0 - half", "ci_low")}, {d("m1 - m0 + half", "ci_high")},
       {d("l1", "test_still_shopping")}, {d("l0", "control_still_shopping")}, {d("cost", "coupon_cost_per_household_week")},
       CASE WHEN m1 - m0 - half > cost THEN 'roll out' WHEN m1 - m0 - half > 0 THEN 'extend' ELSE 'stop' END AS decision
FROM m"""
_VIEW_ROWS = {
    "dim_week": "v_week", "fact_baskets": "v_trips", "fact_category_week": "v_category", "dim_household": "v_dimhome",
    "promo_uplift": f"(SELECT * FROM v_summary WHERE NOT (level = '{schema.LEVEL_MAILER}' AND placement IN ({FREE_ITEMS})))",
    "promo_cannibalisation": "(SELECT * FROM v_cannibal WHERE level = '2. promo type')",
    "campaign_results": "(SELECT DISTINCT 'a', campaign_type FROM v_panel_never UNION ALL "
                        "SELECT DISTINCT 'b', campaign_type FROM v_panel_other)",
}
RESULTS["bi_row_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS view_name, count(*) AS rows FROM {v}" for n, v in _VIEW_ROWS.items())


def _content(name: str, sql: str) -> str:
    """Rows of a query's result and the sum of everything in it that reads as a number."""
    return (f"SELECT '{name}' AS table_name, (SELECT count(*) FROM ({sql})) AS row_count, "
            f"(SELECT floor(list_sum(list_value(*COLUMNS(*))) * 100 + 0.501) / 100 FROM "
            f"(SELECT coalesce(sum(TRY_CAST(COLUMNS(*) AS DOUBLE)), 0) FROM ({sql}))) AS numbers")


RESULTS["report_sink"] = " UNION ALL ".join(_content(sheet, RESULTS[name] if kind is None else
    f"SELECT * EXCLUDE (direction) FROM ({RESULTS[name]}) WHERE direction = '{kind}'") for sheet, name, kind in (
        ("Summary", "weekly_headline", None), ("Departments", "weekly_department_report", None), ("Categories", "weekly_category_report", None),
        ("Rising", "weekly_movers", "rising"), ("Falling", "weekly_movers", "falling")))
_STORED = {
    "transactions": "v_lines", "promotions": "v_promos", "promo_stores": "(SELECT DISTINCT store_id FROM v_promos)",
    "weekly_product_store_sales": "v_weekly", "weekly_category_sales": "v_category", "baskets": "v_trips",
    "households": "v_homes", "season_index": "v_season",
    "pair_timeline": "(SELECT product_id, store_id, week_no FROM v_psweeks UNION SELECT product_id, store_id, week_no "
                     "FROM v_active) SEMI JOIN v_pairs USING (product_id, store_id)",
    "promo_week_uplift": "v_uplift", "uplift_summary": "v_summary", "subcat_weeks": "v_subweeks",
    "cannibalisation_summary": "v_cannibal", "daily_spend": "(SELECT DISTINCT household_key, day FROM v_trips)",
    "campaign_spend": "(SELECT household_key, campaign FROM v_panel_never UNION SELECT household_key, campaign FROM v_panel_other)", "did_members_never": "v_panel_never", "did_members_other": "v_panel_other",
    "did_panel_never": "v_panel_never", "did_panel_other_times": "v_panel_other",
    "did_never": "(SELECT DISTINCT campaign_type FROM v_panel_never)",
    "did_other": "(SELECT DISTINCT campaign_type FROM v_panel_other)",
    "pretrend_never": "(SELECT DISTINCT campaign_type FROM v_panel_never)",
    "pretrend_other": "(SELECT DISTINCT campaign_type FROM v_panel_other)",
    "campaign_did": _VIEW_ROWS["campaign_results"], "rfm_base": "v_scores", "household_rfm": "v_rfm",
    "dim_week": "v_week", "fact_baskets": "v_trips", "fact_category_week": "v_category", "dim_household": "v_dimhome",
    "bi_promo_uplift": _VIEW_ROWS["promo_uplift"], "bi_promo_cannibalisation": _VIEW_ROWS["promo_cannibalisation"],
    "bi_campaign_results": _VIEW_ROWS["campaign_results"],
}
# Stored tables whose query has another name, and those that have none: of these only the rows are compared.
_QUERY_OF = {"transactions": "clean_transactions", "promotions": "clean_promotions", "did_never": "did_by_type",
             "pretrend_never": "pretrend_by_type", "campaign_did": "campaign_results"}
CONTENTS = {n for n in _STORED if _QUERY_OF.get(n, n) in RESULTS}
RESULTS["rebuild_all"] = " UNION ALL ".join(
    _content(n, RESULTS[_QUERY_OF.get(n, n)]) if n in CONTENTS
    else f"SELECT '{n}' AS table_name, count(*) AS row_count, NULL::DOUBLE AS numbers FROM {v}" for n, v in _STORED.items())
RESULTS["weekly_refresh"] = " UNION ALL ".join(
    _content(n, RESULTS[_QUERY_OF.get(n, n)]) for n in ("transactions", "promotions", "weekly_product_store_sales", "weekly_category_sales", "baskets"))
