"""Hypothesis property tests: distributed running sums and AUC equal a direct computation."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnlake.operators.monitor import grouped_auc
from churnlake.operators.ranking import running_sums

rows_strategy = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.25, 0.5, 0.75, 0.9])),
    min_size=4, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_auc_equals_pairwise(spark, rows):
    df = spark.createDataFrame(rows, "g int, actual_churn int, churn_probability double")
    got = {r.g: r.auc for r in grouped_auc(df, ["g"]).collect()}
    for g in {r[0] for r in rows}:
        ys = np.array([r[1] for r in rows if r[0] == g])
        ss = np.array([r[2] for r in rows if r[0] == g])
        pos, neg = ss[ys == 1], ss[ys == 0]
        if len(pos) == 0 or len(neg) == 0:
            assert got[g] is None
        else:
            want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
            assert got[g] == pytest.approx(want, abs=1e-6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=80, unique=True),
       parts=st.integers(1, 9))
def test_running_sums_equal_cumsum(spark, vals, parts):
    rows = [(g, x, x * 2 + 1) for g, x in vals]
    df = spark.createDataFrame(rows, "g int, x int, v int")
    got = {(r.g, r.x): r.cum_v for r in running_sums(df, ["g"], ["x"], ["v"], num_partitions=parts).collect()}
    for g in {r[0] for r in rows}:
        acc = 0
        for _, x, v in sorted(r for r in rows if r[0] == g):
            acc += v
            assert got[(g, x)] == acc
