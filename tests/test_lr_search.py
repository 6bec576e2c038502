"""Batched fits against single fits of the same objective, and prefixes of boosted fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnlake.plans import lr_search, models
from churnlake.session import checkpoint


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(3, 2, 240), rng.normal(0, 1, 240), rng.random(240) < 0.3, rng.random(240) < 0.6]).astype(float)
    y = (rng.random(240) < 1 / (1 + np.exp(-(0.7 * x[:, 0] - 2 - x[:, 1] + 1.2 * x[:, 2])))).astype(float)
    data = [(i % 3, float(t), v.tolist()) for i, (v, t) in enumerate(zip(x, y))]
    return checkpoint(spark.createDataFrame(data, "fold int, label double, x array<double>").repartition(4))


def test_batch_equals_single_fits(spark, rows):
    points = models.lr_points([0.01, 1, 100])
    scaling = lr_search.fold_scaling(rows, 2, 3)
    weights = lr_search.fit_batch(rows, points, [0, 1, 2, lr_search.ALL_ROWS], scaling)
    for a, k in ((0, 0), (3, lr_search.ALL_ROWS)):
        held = [(r["fold"], r["label"], r["x"]) for r in rows.collect() if r["fold"] != k]
        x = np.array([h[2] for h in held])
        if k != lr_search.ALL_ROWS:
            x[:, :2] = (x[:, :2] - x[:, :2].mean(axis=0)) / x[:, :2].std(axis=0, ddof=1)
        # the single solver fits no weight of a constant column; turning every other row round (features and label)
        # leaves each loss as it is
        df = spark.createDataFrame([(h[1] if i % 2 else 1 - h[1], Vectors.dense((np.array([*v, 1.0]) * (1 if i % 2 else -1)).tolist()))
                                    for i, (h, v) in enumerate(zip(held, x))], ["label", "features"]).cache()
        for j, p in enumerate(points):
            single = LogisticRegression(maxIter=2000, tol=1e-12, fitIntercept=False, standardization=False,
                                        regParam=1 / (p["C"] * len(held)), elasticNetParam=float(p["penalty"] == "l1")).fit(df)
            assert np.abs(single.coefficients.toArray() - weights[a, j]).max() < 1e-4, (k, p)
        df.unpersist()


def test_fold_aucs_and_model(spark, rows):
    points = models.lr_points([1], ["l2"])
    scaling = lr_search.fold_scaling(rows, 2, 3)
    weights = lr_search.fit_batch(rows, points, [0, 1, 2], scaling)
    got = {r["fold"]: r["auc"] for r in lr_search.fold_aucs(rows, weights, scaling).collect()}
    held = rows.collect()
    for k in range(3):
        mine = [r for r in held if r["fold"] == k]
        x = lr_search._scaled(np.array([r["x"] for r in mine]), k, scaling) @ weights[k, 0]
        pos, neg = ([z for z, r in zip(x, mine) if r["label"] == c] for c in (1, 0))
        assert got[k] == pytest.approx(np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg]))
    model = lr_search.as_model(spark, weights[0, 0])
    df = spark.createDataFrame([(Vectors.dense(r["x"]),) for r in held[:5]], ["features"])
    for r, out in zip(held, model.transform(df).collect()):
        z = np.dot([*r["x"], 1.0], weights[0, 0])
        assert out["probability"][1] == pytest.approx(1 / (1 + np.exp(-z)))


def test_empty_and_one_class_folds(spark, rows):
    one = checkpoint(rows.where("label = 1 OR fold = 0"))
    scaling = lr_search.fold_scaling(one, 2, 3)
    assert len(lr_search.mean_aucs(one, models.lr_points([1]), 3, scaling)) == 2


def test_prefixes_of_a_boosted_fit(spark, rows):
    vectors = rows.select("fold", "label", F.col("x")).rdd.map(lambda r: (r["fold"], r["label"], Vectors.dense(r["x"]))).toDF(
        ["fold", "label", "features"]).cache()
    inside, outside = vectors.where("fold > 0"), vectors.where("fold = 0")
    points = [{"max_depth": 2, "learning_rate": 0.3, "n_estimators": n, "gamma": 0, "min_child_weight": 1, "subsample": 0.8,
               "colsample_bytree": 1.0} for n in (3, 6)]
    long = models.estimator("gbt", points[1], 0).fit(inside)
    short = models.estimator("gbt", points[0], 0).fit(inside)
    got = models.prefix_margins(long, [3, 6], outside).select("m_3", "m_6").collect()
    for name, model in (("m_3", short), ("m_6", long)):
        want = [r["rawPrediction"][1] for r in model.transform(outside).collect()]
        assert [r[name] for r in got] == pytest.approx(want)
    assert set(models.staged_aucs(inside, outside, points)) == {0, 1}
