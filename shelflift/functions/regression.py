"""Treatment effect from a dummy-variable regression with cluster-robust errors.

The model is ``y ~ treated + C(a) + C(b)`` fitted separately for each group. Every regressor is constant
inside a cell (group, a, b, treated), so counts and sums per cell are all the fit needs. The levels of ``a``, of which there may be many (campaigns), are
eliminated: within each level, regressors and outcome are taken relative to the level's mean, which leaves a system of the treatment and the few
levels of ``b`` (deciles) alone. Each level of ``a`` adds its share to that system's entries (the Schur complement), an ordinary sum; only the summed entries, the square of
the number of levels of ``b``, meet in one task to be solved. Back in the cells, a level's mean is restored by a window over its cells.

That gives, for every cell, its fitted value and the weight with which a residual of that cell enters the treatment
coefficient. The clustered variance is then the sum over clusters of (sum of weight * residual) squared:
two ordinary aggregations over the full data, which never leaves the executors.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelflift.functions.columns import ratio
from shelflift.functions.distributions import normal_two_sided_p
from shelflift.sources.tables import materialize, scratch_path

# A fit with more cells than this is joined like any other table.
BROADCAST_CELLS = 100_000
TREATED, OUTCOME = "treated", "outcome"  # names of the system's entries beside the levels of b

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _entries(cells: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """``(group, i, j, v)``: the entries of the system that is left once the levels of ``a`` are eliminated, i and j being a level of ``b``, TREATED or OUTCOME.

    The sums over cells less, for each level of ``a``, the products of its sums over its size.
    """
    t, n, y, level = F.col("treated").cast("double"), F.col("n").cast("double"), F.col("y_sum"), F.concat(F.lit("b"), F.col(b).cast("string"))
    entry = lambda i, j, v: F.struct(i.alias("i"), j.alias("j"), v.alias("v"))
    treated, outcome = F.lit(TREATED), F.lit(OUTCOME)
    own = cells.select(group, F.explode(F.array(
        entry(treated, treated, n * t * t), entry(treated, level, n * t), entry(level, treated, n * t), entry(level, level, n),
        entry(treated, outcome, t * y), entry(level, outcome, y))).alias("e")).select(group, "e.*")
    part = F.explode(F.array(
        F.struct(level.alias("i"), n.alias("v")), F.struct(treated.alias("i"), (n * t).alias("v")), F.struct(outcome.alias("i"), y.alias("v"))))
    sums = cells.select(group, a, "n", part.alias("p")).groupBy(group, a, "p.i").agg(F.sum("p.v").alias("v"), F.sum("n").alias("n"))
    of_level = sums.groupBy(group, a).agg(F.collect_list(F.struct("i", "v")).alias("parts"), F.max(F.when(F.col("i") == TREATED, F.col("n"))).alias("size"))
    rows = of_level.select(group, "size", "parts", F.explode("parts").alias("x")).where(F.col("x.i") != OUTCOME)
    pairs = rows.select(group, "size", "x", F.explode("parts").alias("z")).select(
        group, F.col("x.i").alias("i"), F.col("z.i").alias("j"), (-F.col("x.v") * F.col("z.v") / F.col("size")).alias("v"))
    return own.unionByName(pairs).groupBy(group, "i", "j").agg(F.sum("v").alias("v"))


def _solve(entries: pd.DataFrame) -> pd.DataFrame:
    """(i, coef, bread) of one group's system: the coefficients, and the treatment's row of the inverse."""
    table = entries.pivot(index="i", columns="j", values="v").fillna(0.0)
    names = list(table.index)
    inverse = np.linalg.pinv(table[names].to_numpy(float), rcond=1e-12, hermitian=True)
    return pd.DataFrame({"i": names, "coef": inverse @ table[OUTCOME].to_numpy(float), "bread": inverse[names.index(TREATED)]})


def fit_cells(cells: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """``cells`` (group, a, b, treated, n, y_sum) with fitted, weight, effect (NULL without both arms) and columns (of the full design)."""
    kinds = dict(cells.dtypes)
    solved = _entries(cells, group, a, b).groupBy(group).applyInPandas(
        lambda pdf: _solve(pdf).assign(**{group: pdf[group].iloc[0]})[[group, "i", "coef", "bread"]], f"`{group}` {kinds[group]}, i string, coef double, bread double")
    by_name = solved.groupBy(group).agg(
        F.map_from_entries(F.collect_list(F.struct("i", "coef"))).alias("coef"), F.map_from_entries(F.collect_list(F.struct("i", "bread"))).alias("bread"))
    sizes = cells.groupBy(group, a).agg(F.collect_set(b).alias("_b"), F.collect_set("treated").alias("_t")).groupBy(group).agg(
        (F.count(F.lit(1)) + F.size(F.array_distinct(F.flatten(F.collect_set("_b"))))).alias("columns"),
        (F.size(F.array_distinct(F.flatten(F.collect_set("_t")))) == 2).alias("_both"))
    level = Window.partitionBy(group, a)

    def centred(of: str) -> Column:
        x = F.col("treated") * F.col(of)[TREATED] + F.col(of)[F.concat(F.lit("b"), F.col(b).cast("string"))]
        return x - F.sum(x * F.col("n")).over(level) / F.sum("n").over(level)

    mean = F.sum("y_sum").over(level) / F.sum("n").over(level)
    # Both sides of the joins have a row per group: a handful, of the size of the levels of b.
    return cells.join(by_name, group).join(sizes, group).select(
        *cells.columns, (mean + centred("coef")).alias("fitted"), centred("bread").alias("weight"),
        F.when(F.col("_both"), F.col("coef")[TREATED]).alias("effect"), F.col("columns").cast("bigint").alias("columns"))


def clustered_treatment_effect(
    panel: DataFrame, outcome: str, group: str, a: str, b: str, cluster: str, z: float
) -> DataFrame:
    """``(group, effect, se, ci95_low, ci95_high, p_value)`` of the ``treated`` coefficient.

    Small-sample factor G/(G-1) * (N-1)/(N-K) and normal p-values, as usual for clustered fits.
    """
    keys = [group, a, b, "treated"]
    rows = panel.select(*keys, cluster, F.col(outcome).cast("double").alias("_y")).where("_y IS NOT NULL")
    cells = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("y_sum"))
    cells = materialize(cells, scratch_path(panel.sparkSession, "cells"))  # read several times
    fit = fit_cells(cells, group, a, b)
    few = cells.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    scores = (
        rows.join(F.broadcast(fit.drop("n", "y_sum")) if few else fit.drop("n", "y_sum"), keys)
        .groupBy(group, cluster)
        .agg(
            F.sum(F.col("weight") * (F.col("_y") - F.col("fitted"))).alias("score"),
            F.count(F.lit(1)).alias("n"),
            F.max("effect").alias("effect"),
            F.max("columns").alias("k"),
        )
    )
    groups, rows_n = F.col("clusters"), F.col("rows")
    factor = ratio(groups, groups - 1) * ratio(rows_n - 1, rows_n - F.col("k"))
    return (
        scores.groupBy(group)
        .agg(
            F.sum(F.col("score") * F.col("score")).alias("meat"),
            F.count(F.lit(1)).alias("clusters"),
            F.sum("n").alias("rows"),
            F.max("effect").alias("effect"),
            F.max("k").alias("k"),
        )
        .withColumn("se", F.sqrt(factor * F.col("meat")))
        .select(
            group,
            "effect",
            "se",
            (F.col("effect") - z * F.col("se")).alias("ci95_low"),
            (F.col("effect") + z * F.col("se")).alias("ci95_high"),
            normal_two_sided_p(F.try_divide(F.col("effect"), F.col("se"))).alias("p_value"),
        )
    )
