import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelflift.functions import distributions as dist
from shelflift.functions.intervals import wilson
from shelflift.functions.ranking import exact_quantiles, ntile, ntiles, quantile_bin, running_total
from shelflift.functions.regression import clustered_treatment_effect
from shelflift.operators import experiment


def test_tail_probabilities():
    # Published table values.
    assert dist.upper_gamma(3 / 2, 7.814727903251179 / 2) == pytest.approx(0.05, abs=1e-10)
    assert dist.upper_gamma(1 / 2, 3.841458820694124 / 2) == pytest.approx(0.05, abs=1e-10)
    assert dist.incomplete_beta(5, 0.5, 10 / (10 + 2.2281388519649385 ** 2)) == pytest.approx(0.05, abs=1e-10)
    assert dist.incomplete_beta(0.5, 0.5, 1 / (1 + 12.706204736432095 ** 2)) == pytest.approx(0.05, abs=1e-10)


def test_group_sizes_for_the_t_test():
    # Published sizes at 5 % two-sided and 80 % power, by effect; published power of 30 per group at half a deviation.
    published = {0.2: 394, 0.3: 176, 0.5: 64, 0.8: 26, 1.0: 17}
    assert {d: dist.t_test_group_size(d, 0.05, 0.8) for d in published} == published
    assert dist.t_test_power(0.5, 30, 0.05) == pytest.approx(0.4779, abs=1e-4)
    assert dist.t_test_power(0.0, 12, 0.05) == pytest.approx(0.05, abs=1e-6)
    assert dist.t_critical(0.025, 10) == pytest.approx(2.2281388519649385) and dist.t_critical(0.025, 1) == pytest.approx(12.706204736432095)
    assert dist.t_critical(0.025, 1000) == pytest.approx(dist.t_critical(0.025, 1000 + 1e-9), abs=1e-9)
    # The normal form leaves out the other tail, 1e-6 here, so its size is larger by 2.4e-6 of it.
    assert dist.t_test_group_size(1e-5, 0.05, 0.8) == pytest.approx(2 * 2.8015852181 ** 2 * 1e10 * (1 - 2.4e-6), rel=1e-7) and np.isnan(dist.t_test_group_size(0.0, 0.05, 0.8))


def test_p_values_of_missing_statistics_are_missing(frame):
    row = frame("t double, d double", [(None, 3.0)]).select(dist.student_two_sided_p("t", "d").alias("p")).first()
    assert row.p is None or np.isnan(row.p)


def test_wilson_bounds_without_successes(frame):
    low, high = wilson(F.col("x"), F.col("n"))
    row = frame("x bigint, n bigint", [(0, 10)]).select(low.alias("l"), high.alias("h")).first()
    assert row.l == pytest.approx(0, abs=1e-12) and row.h == pytest.approx(0.27753, abs=1e-4)


@pytest.mark.parametrize("n", [1, 3, 7, 11, 1000])
def test_ntile_matches_sql(frame, n):
    draw = random.Random(n)
    rows = [(k, draw.choice([0, 0, 0, 1, 2, 500])) for k in range(n)]
    df = frame("k bigint, v int", rows)
    got = {r.k: r.t for r in ntile(df, 5, "v", "k", "t").collect()}
    df.createOrReplaceTempView("ntile_rows")
    want = {r.k: r.t for r in df.sparkSession.sql(
        "SELECT k, ntile(5) OVER (ORDER BY v, k) t FROM ntile_rows").collect()}
    assert got == want


@pytest.mark.parametrize("n", [0, 1, 3, 7, 403])
def test_tiles_of_several_orders_match_sql(frame, n):
    draw = random.Random(n)
    rows = [(k, draw.choice([0, 0, 0, 1, 2, 500, None]), draw.choice([7.5, 7.5, 7.5, draw.random()]), 3) for k in draw.sample(range(5 * n + 1), n)]
    df = frame("k bigint, v int, w double, same int", rows)
    got = ntiles(df, 5, {"a": ("v", False), "b": ("v", True), "c": ("w", False), "d": ("same", True)}, "k")
    assert got.columns == ["k", "v", "w", "same", "a", "b", "c", "d"]
    df.createOrReplaceTempView("tile_rows")
    want = df.sparkSession.sql("""SELECT k, ntile(5) OVER (ORDER BY v NULLS FIRST, k) a, ntile(5) OVER (ORDER BY -v NULLS FIRST, k) b,
        ntile(5) OVER (ORDER BY w, k) c, ntile(5) OVER (ORDER BY k) d FROM tile_rows""")
    assert sorted(tuple(r) for r in got.select("k", "a", "b", "c", "d").collect()) == sorted(tuple(r) for r in want.collect())


def test_chained_ranks_of_one_hot_value(frame):
    df = frame("k bigint, v int, g string", [(k, 7 if k % 3 else k, "hot" if k % 4 else "cold") for k in range(2000)])
    ranked = running_total(df, "v", "k", by=["g"])
    for g, rows in pd.DataFrame([r.asDict() for r in ranked.collect()]).groupby("g"):
        assert (rows.sort_values(["v", "k"]).row_num.to_numpy() == np.arange(1, len(rows) + 1)).all()
        assert (rows.group_rows == len(rows)).all()


@pytest.mark.parametrize("n", [10, 37, 100, 251])
def test_bins_match_interpolated_edges(frame, n):
    rows = frame("rn bigint", [(k,) for k in range(1, n + 1)])
    got = [r.b for r in rows.select("rn", quantile_bin(F.col("rn"), F.lit(n), 10).alias("b")).orderBy("rn").collect()]
    assert got == list(pd.qcut(pd.Series(range(1, n + 1)), 10, labels=False))


def test_quantiles_are_interpolated(frame):
    draw = random.Random(3)
    values = [draw.choice([-4.5, 0.0, 0.0, draw.random()]) for _ in range(501)]
    df = frame("g string, v double", [("a", v) for v in values] + [("a", None), ("b", 1.0)])
    got = {r.g: list(r)[1:] for r in exact_quantiles(df.groupBy("g", "v").agg(F.count("*").alias("c")), [0.0, 0.25, 0.5, 0.9, 1.0], "g").collect()}
    assert got["a"] == pytest.approx(list(np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0]))) and got["b"] == [1.0] * 5


@pytest.mark.parametrize("share", [0.2, 0.9, 1.0])
def test_null_values_are_ranked_first(frame, share):
    draw = random.Random(5)
    rows = [(k, None if draw.random() < share else draw.randrange(5)) for k in range(1000)]
    got = {r.k: r.row_num for r in running_total(frame("k bigint, v int", rows), "v", "k", cuts=8).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert got == {k: i + 1 for i, (k, _) in enumerate(order)}


def draw_of(name, salt):
    return experiment.draw(F.col(name), salt)


def test_draws_are_one_to_one(spark):
    keys = [*range(5000), *[k * 1_000_003 for k in range(1, 2000)], 2**31 - 1, 2**52]
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", draw_of("k", 17).alias("d"), draw_of("k", 18).alias("e")).collect()
    p, want = experiment.PRIME, {}
    for k in keys:
        x = (k * experiment.MULTIPLIER + 17 * experiment.SALT_MULTIPLIER % p + experiment.OFFSET) % p
        want[k] = pow(pow(x, 3, p) + experiment.OFFSET, 3, p)
    assert {r.k: r.d for r in rows} == want and len(set(want.values())) == len(set(keys))
    assert all(r.d != r.e for r in rows)


def panel(seed=1, effect=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for h in range(120):
        habit = rng.normal()
        for c in range(1, 5):
            if rng.random() < 0.7:
                t = int(rng.random() < 0.4)
                rows.append(("TypeA" if c < 4 else "TypeB", c, int(rng.integers(0, 10)), t, h,
                             float(habit + 0.3 * c + rng.normal() + effect * t)))
    return rows


SCHEMA = "campaign_type string, campaign int, spend_decile int, treated int, household_key int, y double"


def dense(rows, kind):
    """The same model with a full design matrix."""
    d = pd.DataFrame([r for r in rows if r[0] == kind], columns=["t", "c", "q", "treated", "h", "y"])
    x = np.column_stack([np.ones(len(d)), d.treated, pd.get_dummies(d.c, drop_first=True, dtype=float),
                         pd.get_dummies(d.q, drop_first=True, dtype=float)]).astype(float)
    bread = np.linalg.pinv(x.T @ x)
    coef = bread @ x.T @ d.y
    u = (d.y - x @ coef).to_numpy()
    meat = sum(np.outer(s, s) for s in (x[i].T @ u[i] for i in d.groupby("h").indices.values()))
    g, n, k = d.h.nunique(), len(d), x.shape[1]
    return coef[1], np.sqrt((bread @ meat @ bread)[1, 1] * g / (g - 1) * (n - 1) / (n - k))


def fit(frame, rows):
    out = clustered_treatment_effect(
        frame(SCHEMA, rows), "y", "campaign_type", "campaign", "spend_decile", "household_key", 1.96)
    return {r.campaign_type: r for r in out.collect()}


def test_clustered_effect_equals_dense_regression(frame):
    rows = panel()
    got = fit(frame, rows)
    for kind in ("TypeA", "TypeB"):
        effect, se = dense(rows, kind)
        assert got[kind].effect == pytest.approx(effect, abs=1e-9)
        assert got[kind].se == pytest.approx(se, abs=1e-9)
        assert 0 <= got[kind].p_value <= 1


def test_planted_effect_is_recovered(frame):
    plain, planted = fit(frame, panel()), fit(frame, panel(effect=5.0))
    for kind in plain:
        assert planted[kind].effect - plain[kind].effect == pytest.approx(5.0, abs=1e-9)


def test_interval_sets_against_all_pairs(frame):
    """Nested, touching, equal, empty and null intervals; keys on one side only."""

    from shelflift.functions.interval_sets import merged_intervals, overlap_join

    rnd = random.Random(9)
    right = [(rnd.randrange(6), s := rnd.randrange(60), s + rnd.choice([-1, 0, 0, 3, 20])) for _ in range(60)] + [(1, None, 5), (None, 1, 90), (2, 10, 30), (2, 12, 15), (2, 30, 40)]
    left = [(rnd.randrange(8), i, s := rnd.randrange(70), s + rnd.randrange(12)) for i in range(300)] + [(None, 900, 1, 2), (1, 901, None, 2)]
    a, b = frame("k int, i int, low int, high int", left), frame("k int, start int, end int", right)
    met = {i for k, i, low, high in left if any(
        k == r and None not in (k, low, s, e) and s <= e and s <= high and e >= low for r, s, e in right)}
    for anti in (False, True):
        got = {r.i for r in overlap_join(a, b, ["k"], "low", "high", "start", "end", anti).collect()}
        assert got == ({x[1] for x in left} - met if anti else met)
    covered = lambda rows: {(k, x) for k, s, e in rows if None not in (s, e) for x in range(s, e + 1)}
    merged = [tuple(r) for r in merged_intervals(b, ["k"], "start", "end").collect()]
    assert covered(merged) == covered(right) and len(covered(merged)) == sum(e - s + 1 for _, s, e in merged)


def test_search_in_sorted_arrays(frame):
    from shelflift.functions.interval_sets import count_upto, holds

    rows = [(a, x) for a in (None, [], [3], [1, 1, 4], list(range(0, 100, 3))) for x in (-1, 0, 1, 3, 4, 50, 99, 200)]
    got = frame("a array<int>, x int", rows).select("a", "x", count_upto(F.col("a"), F.col("x")), holds(F.col("a"), F.col("x"))).collect()
    for r in got:
        assert r[2] == sum(v <= r.x for v in r.a or []) and r[3] == (r.x in (r.a or []))


def test_many_campaigns_are_eliminated(frame, spark):
    """600 campaigns against a least-squares fit, 5,000 by the size of what meets in one task."""
    from shelflift.functions.regression import _entries

    rng = np.random.default_rng(4)
    rows = [("TypeA", c, int(rng.integers(0, 10)), int(rng.random() < 0.5), int(rng.integers(0, 400)), float(rng.normal() + c % 7)) for c in range(600) for _ in range(8)]
    d = pd.DataFrame(rows, columns=["t", "c", "q", "treated", "h", "y"])
    x = np.column_stack([d.treated, pd.get_dummies(d.c, dtype=float), pd.get_dummies(d.q, drop_first=True, dtype=float)]).astype(float)
    coef = np.linalg.lstsq(x, d.y.to_numpy(), rcond=None)[0]
    assert fit(frame, rows)["TypeA"].effect == pytest.approx(coef[0], abs=1e-8)
    cells = spark.range(100_000).selectExpr("'T' AS g", "id DIV 20 AS a", "id DIV 2 % 10 AS b", "cast(id % 2 AS int) AS treated", "1 + id % 3 AS n", "cast(id % 11 AS double) AS y_sum")
    assert _entries(cells, "g", "a", "b").count() == 11 * 12
