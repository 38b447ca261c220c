from decimal import Decimal as D

import pytest

from shelflift.operators import bi, campaign, experiment, segments, weekly
from shelflift.params import Params

P = Params()
TRIPS = ("basket_id bigint, household_key int, store_id int, day int, week_no int, basket_value decimal(20,2), "
         "items bigint, lines bigint, discount decimal(20,2), used_coupon boolean")


def trip(household, day, value="7.00", basket=None):
    return (basket or household * 1000 + day, household, 1, day, (day - 1) // 7 + 1, D(value), 1, 1, D("0.00"), False)


CAMPAIGNS = "campaign int, campaign_type string, start_day int, end_day int"
TARGETS = "description string, household_key int, campaign int"


def test_single_shopping_day_uses_the_default_gap(frame):
    trips = frame(TRIPS, [trip(1, 711), trip(1, 711, basket=5), trip(2, 683), trip(3, 682)]
                  + [trip(4, d) for d in (600, 620, 640, 660)])
    base = segments.rfm_base(trips, P)
    rfm = segments.household_rfm(segments.rfm_scores(base), segments.gap_stats(segments.trip_gaps(trips)),
                                 segments.recent_13w(trips, P), P)
    rows = {r.household_key: r for r in rfm.collect()}
    assert rows[1].p90_gap is None and not rows[1].gone_quiet
    assert not rows[2].gone_quiet and rows[3].gone_quiet
    assert rows[4].p90_gap == 20 and rows[4].gone_quiet
    assert rows[4].last_13w_sales == D("14.00") and rows[4].prev_13w_sales == D("14.00") and not rows[4].fading


def test_quintile_sizes_with_seven_households(frame):
    base = frame("household_key int, days_since_last int, trips bigint, sales decimal(20,2)",
                 [(h, 5, 3, D("1.00")) for h in range(1, 8)])
    scores = [r.f_score for r in segments.rfm_scores(base).orderBy("household_key").collect()]
    assert scores == [1, 1, 2, 2, 3, 4, 5]


def test_retention_of_the_last_quarter_is_unknown(frame):
    trips = frame(TRIPS, [trip(1, 1), trip(1, 92), trip(2, 91), trip(3, 92)])
    rows = {r.quarter: r for r in segments.retention_by_quarter(trips, P).collect()}
    assert (rows[1].active_households, rows[1].still_active_next_quarter, rows[1].retention_rate) == (2, 1, 0.5)
    assert rows[2].still_active_next_quarter is None and rows[2].retention_rate is None


def test_window_edges_and_clipped_end(frame):
    start = 300
    campaigns = frame(CAMPAIGNS, [(1, "TypeA", start, 719)])
    trips = frame(TRIPS, [trip(1, start - 1, "8.00"), trip(1, start, "1.00"), trip(1, start - 56, "16.00"),
                          trip(1, start - 57, "4.00"), trip(1, start - 112, "2.00"), trip(1, start - 113, "3.00"),
                          trip(2, start - 57), trip(3, start - 1)])
    targets = frame(TARGETS, [("TypeA", 1, 1)])
    spent = campaign.campaign_spend(campaign.spend_index(campaign.daily_spend(trips)), campaigns, targets, P)
    panel = campaign.did_panel(campaign.did_members(spent), campaigns, P)
    rows = {r.household_key: r for r in panel.collect()}
    assert set(rows) == {1, 3} and rows[1].treated == 1 and rows[3].treated == 0
    one = rows[1]
    assert one.before == 24 / 8 and one.earlier == 6 / 8
    assert one.during == pytest.approx(1 / ((711 - start + 1) / 7))
    assert one.history == pytest.approx(3 / ((start - 113) / 7))


def test_early_campaign_has_no_history(frame):
    campaigns = frame(CAMPAIGNS, [(1, "TypeA", 100, 120)])
    trips = frame(TRIPS, [trip(1, 99), trip(2, 98)])
    targets = frame(TARGETS, [("TypeA", 1, 1)])
    spent = campaign.campaign_spend(campaign.spend_index(campaign.daily_spend(trips)), campaigns, targets, P)
    rows = campaign.did_panel(campaign.did_members(spent), campaigns, P).collect()
    assert len(rows) == 2 and all(r.history is None for r in rows)
    assert {r.household_key: r.spend_decile for r in rows}[1] == 0


def test_other_times_excludes_busy_households(frame):
    campaigns = frame(CAMPAIGNS, [(1, "TypeA", 400, 420), (2, "TypeA", 290, 299), (3, "TypeA", 200, 287)])
    trips = frame(TRIPS, [trip(h, 399) for h in (1, 2, 3, 4)])
    targets = frame(TARGETS, [("TypeA", 1, 1), ("TypeA", 2, 2), ("TypeA", 3, 3)])
    spent = campaign.campaign_spend(campaign.spend_index(campaign.daily_spend(trips)), campaigns, targets, P)
    members = campaign.did_members(spent, campaign.OTHER_TIMES).where("campaign = 1")
    assert {(r.household_key, r.treated) for r in members.collect()} == {(1, 1), (3, 0)}


def test_event_weeks_floor_towards_the_past(frame):
    campaigns = frame(CAMPAIGNS, [(1, "TypeA", 300, 320)])
    trips = frame(TRIPS, [trip(1, 299, "9.00"), trip(1, 300, "17.00"), trip(2, 298, "1.00")])
    targets = frame(TARGETS, [("TypeA", 1, 1)])
    daily = campaign.daily_spend(trips)
    spent = campaign.campaign_spend(campaign.spend_index(daily), campaigns, targets, P)
    panel = campaign.did_panel(campaign.did_members(spent), campaigns, P)
    gaps = {r.rel_week: r.gap for r in campaign.event_study(campaign.spend_index(daily), campaigns, panel, P).collect()}
    assert len(gaps) == 17
    assert gaps[-1] == pytest.approx(8 - 1) and gaps[0] == pytest.approx(17 - 1) and gaps[5] == pytest.approx(-1)


def test_report_changes_are_missing_without_a_base(frame):
    rows = [("A", "X", 60, "200.00"), ("A", "X", 59, "100.00"), ("A", "Y", 60, "50.00"), ("A", "Z", 8, "5.00"),
            ("A", "W", 7, "5.00")]
    weeks = frame("department string, commodity_desc string, week_no int, sales decimal(20,2), discount decimal(20,2)",
                  [(d, c, w, D(s), D("1.00")) for d, c, w, s in rows])
    from pyspark.sql import functions as F

    report = weekly.weekly_category_report(weeks, F.lit(60))
    got = {r.category: r for r in report.collect()}
    assert set(got) == {"X", "Y", "Z"}
    assert got["X"].vs_last_week == 1.0 and got["X"].avg_last_4_weeks == 25 and got["X"].vs_last_year is None
    assert got["Y"].vs_last_week is None and got["Y"].share_of_sales == pytest.approx(0.2)
    assert got["Z"].same_week_last_year == 5 and got["Z"].vs_last_year == -1 and got["Z"].discount_pct is None
    department = weekly.weekly_department_report(report).first()
    assert department.sales_this_week == 250 and department.vs_last_week == 1.5
    movers = weekly.weekly_movers(report, Params(mover_min_sales=20)).collect()
    assert [(r.category, r.direction) for r in movers] == [("X", "rising")]


def test_incomplete_weeks_are_not_reported(frame):
    trips = frame(TRIPS, [trip(1, d) for d in range(1, 8)] + [trip(1, d) for d in range(8, 13)])
    weeks = bi.dim_week(trips, P)
    assert weekly.latest_complete_week(weeks).first().week_no == 1


def test_assignment_splits_each_segment_in_half(frame):
    pool = frame("household_key int, segment string", [(h, "a" if h % 3 else "b") for h in range(301)])
    rows = experiment.ab_assignment(pool).collect()
    for s in "ab":
        arms = [r.arm for r in rows if r.segment == s]
        assert abs(arms.count("test") - arms.count("control")) <= 1
    again = {r.household_key: r.arm for r in experiment.ab_assignment(pool).collect()}
    assert again == {r.household_key: r.arm for r in rows} and len(again) == 301


def test_sample_sizes_match_the_published_scale(frame):
    stats = frame("pool string, mean_weekly_spend double, sd_weekly_spend double", [("all", 13.29, 19.41)])
    rows = {r.lift_to_detect: r.households_per_group for r in experiment.ab_sample_size(stats, P).collect()}
    assert 3300 < rows[0.10] < 3400 and rows[0.05] > 4 * rows[0.10] - 5
    backtest = frame("flagged boolean, came_back double", [(True, 0.68), (False, 0.95)])
    assert 1250 < experiment.ab_sample_size_prop(backtest, P).first().households_per_group < 1350


def test_exact_sample_sizes(frame):
    stats = frame("pool string, mean_weekly_spend double, sd_weekly_spend double", [("all", 13.29, 19.41), ("none", 0.0, 1.0), ("flat", 5.0, 0.0), ("gone", None, None)])
    rows = {(r.pool, r.lift_to_detect): r.households_per_group for r in experiment.ab_sample_size_exact(stats, P).collect()}
    assert rows["all", 0.10] == 3350 and {v for k, v in rows.items() if k[0] != "all"} == {None} and len(rows) == 16


def test_memberships_search_no_campaign_per_household(frame):
    days = [(1, 400, 420), (2, 290, 299), (3, 200, 287), (4, 700, 719), (5, 650, 600), (6, 500, None), (7, 800, 810), (1, 480, 490)]
    campaigns = frame(CAMPAIGNS, [(c, "TypeA", s, e) for c, s, e in days])
    targets = {(1, 1), (2, 2), (3, 3), (4, 5), (4, 6), (5, 7), (5, 4), (6, None), (None, 2), (7, 99)}
    index = frame("household_key int, days array<int>, upto array<decimal(38,2)>", [(h, [10], [D("1.00")]) for h in range(1, 9)])
    found = campaign.memberships(index, campaigns, frame(TARGETS, [("TypeA", h, c) for h, c in targets]), P)
    # Which campaigns run at the same time is worked out on the campaigns, not by sorting and searching every household's own ones.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "aggregate(" not in plan
    wanted = set()
    for h in range(1, 9):
        own = {c for home, c in targets if home == h}
        ran = [(s, e) for c, s, e in days if c in own and e is not None and s <= e]
        ever = any(c in own for c, _, _ in days)
        for c, s, e in days:
            last = 711 if e is None else min(e, 711)
            busy = any(a <= last and b >= s - 112 for a, b in ran)
            if s <= 711 and (c in own or not ever or not busy):
                wanted.add((h, c, s, last, c in own, ever, busy))
    rows = [(r.household_key, *m) for r in found.collect() for m in r.members]
    assert set(rows) == wanted and len(rows) == len(wanted)
