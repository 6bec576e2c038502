"""Closed-form checks of AUC, quantiles, PSI and KDE against independent numpy code."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlake.operators.monitor import grouped_auc, kde_table, psi_table
from churnlake.operators.ranking import exact_quantiles, exact_rank, running_sums


def _pairwise_auc(y, s):
    pos = [x for x, t in zip(s, y) if t == 1]
    neg = [x for x, t in zip(s, y) if t == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_with_ties_matches_pairwise(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g in range(3):
        y = rng.integers(0, 2, 300)
        s = np.round(rng.random(300) * 5) / 5 + 0.1 * y  # many ties
        rows += [(g, int(a), float(b)) for a, b in zip(y, s)]
    df = spark.createDataFrame(rows, "g int, actual_churn int, churn_probability double")
    got = {r.g: r.auc for r in grouped_auc(df, ["g"]).collect()}
    for g in range(3):
        ys = [r[1] for r in rows if r[0] == g]
        ss = [r[2] for r in rows if r[0] == g]
        assert got[g] == pytest.approx(_pairwise_auc(ys, ss), abs=1e-6)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(0, 1, 0.2), (0, 1, 0.4)], "g int, actual_churn int, churn_probability double")
    assert grouped_auc(df, ["g"]).first().auc is None


def test_running_sums_span_partitions(spark):
    rows = [(g, i, 1) for g in range(2) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, x int, v int")
    out = running_sums(df, ["g"], ["x"], ["v"], num_partitions=7).collect()
    assert all(r.cum_v == r.x + 1 for r in out)
    ranked = exact_rank(df.drop("v"), ["g"], ["x"], "rk").collect()
    assert all(r.rk == r.x + 1 for r in ranked)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(50, 20, 999), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [i / 10 for i in range(11)]
    got = sorted((r.q_idx, r.value) for r in exact_quantiles(df, "v", probs).collect())
    want = np.percentile(vals, [p * 100 for p in probs])
    assert [v for _, v in got] == pytest.approx(list(want), abs=1e-9)


def _numpy_psi(expected, actual):
    bins = np.unique(np.percentile(expected, list(range(0, 101, 10))))
    bins[0], bins[-1] = -np.inf, np.inf
    e = pd.cut(pd.Series(expected), bins).value_counts().sort_index() / len(expected)
    a = pd.cut(pd.Series(actual), bins).value_counts().sort_index() / len(actual)
    e, a = e.replace(0, 1e-4), a.replace(0, 1e-4)
    return float(((a - e) * np.log(a / e)).sum())


def test_psi_matches_numpy_and_properties(spark):
    rng = np.random.default_rng(11)
    base = np.round(rng.gamma(2, 30, 500), 2)
    shifted = np.round(rng.gamma(2, 34, 400), 2)
    rows = [("f", 0, float(v)) for v in base] + [("f", 1, float(v)) for v in shifted]
    df = spark.createDataFrame(rows, "feature string, m int, value double").withColumnRenamed("m", "month_start")
    got = {r.month_start: r.psi for r in psi_table(df, F.col("month_start") == 0).collect()}
    assert got[0] == pytest.approx(0.0, abs=1e-9)
    assert got[1] == pytest.approx(_numpy_psi(base, shifted), abs=1e-6)
    assert got[1] >= 0


def test_psi_constant_baseline_is_zero(spark):
    rows = [("f", 0, 5.0)] * 20 + [("f", 1, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "feature string, month_start int, value double")
    got = {r.month_start: r.psi for r in psi_table(df, F.col("month_start") == 0).collect()}
    assert got[1] == 0.0


def test_kde_matches_gaussian_formula(spark):
    rng = np.random.default_rng(5)
    vals = np.round(rng.normal(0.4, 0.1, 250), 3)
    df = spark.createDataFrame([("s", 0, float(v)) for v in vals], "feature string, month_start int, value double")
    got = sorted((r.point, r.x, r.density) for r in kde_table(df).collect())
    bw = vals.std(ddof=1) * len(vals) ** -0.2
    grid = np.linspace(vals.min() - 3 * bw, vals.max() + 3 * bw, 200)
    dens = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / bw) ** 2).sum(1) / (len(vals) * bw * math.sqrt(2 * math.pi))
    assert len(got) == 200
    assert [x for _, x, _ in got] == pytest.approx(list(grid), abs=1e-6)
    assert [d for _, _, d in got] == pytest.approx(list(dens), abs=1e-6)


def test_kde_binned_close_to_exact(spark):
    rng = np.random.default_rng(9)
    vals = rng.normal(0.4, 0.1, 2000)
    df = spark.createDataFrame([("s", 0, float(v)) for v in vals], "feature string, month_start int, value double")
    exact = sorted((r.point, r.density) for r in kde_table(df).collect())
    binned = sorted((r.point, r.density) for r in kde_table(df, bin_fraction=0.02).collect())
    peak = max(d for _, d in exact)
    assert max(abs(a[1] - b[1]) for a, b in zip(exact, binned)) < 1e-3 * peak


def test_approx_options_close_to_exact(spark):
    from churnlake.operators.monitor import approx_quantiles
    rng = np.random.default_rng(21)
    base = np.round(rng.gamma(2, 30, 3000), 2)
    later = np.round(rng.gamma(2, 33, 3000), 2)
    rows = [("f", 0, float(v)) for v in base] + [("f", 1, float(v)) for v in later]
    df = spark.createDataFrame(rows, "feature string, month_start int, value double")
    probs = [i / 10 for i in range(11)]
    approx = sorted((r.q_idx, r.value) for r in approx_quantiles(df.where("month_start = 0"), probs, ["feature"]).collect())
    want = np.percentile(base, [p * 100 for p in probs])
    ranks = [np.searchsorted(np.sort(base), v) / len(base) for _, v in approx]
    assert all(abs(r - p) <= 0.01 for r, p in zip(ranks, probs))  # rank error within the sketch bound
    exact = {r.month_start: r.psi for r in psi_table(df, F.col("month_start") == 0).collect()}
    est = {r.month_start: r.psi for r in psi_table(df, F.col("month_start") == 0, exact=False).collect()}
    assert est[1] == pytest.approx(exact[1], abs=0.02)
    assert want[0] <= approx[0][1] and approx[-1][1] <= want[-1]
