"""The tree search: whole space, and fits of all points at once against single fits."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.linalg import Vectors

from churnlake.plans import gbt_search, models, registry
from churnlake.session import shared_path


def test_registered_search_runs_the_whole_space(spark, monkeypatch):
    rows = spark.createDataFrame([("train", 1.0), ("test", 0.0)], "part string, label double")
    asked = []

    def search(train, kind, points, folds=models.FOLDS):
        asked.append((kind, points, folds))
        return models.Search(points, [0.5] * len(points), None)

    monkeypatch.setattr(registry, "_model_data", lambda spark, sf_dir: rows)
    monkeypatch.setattr(models, "search", search)
    table = registry.gbt_random_search(spark, "")
    (kind, points, folds), = asked
    assert (kind, len(points), folds, table.count()) == ("gbt", 50, 5, 50)
    assert points == models.tree_points() and len({tuple(p.items()) for p in points}) == 50
    for name, values in models.TREE_GRID.items():
        assert {p[name] for p in points} == set(values)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(0, 1, 600), rng.gamma(2, 2, 600), rng.integers(0, 6, 600), rng.random(600) < 0.3]).astype(float)
    y = (rng.random(600) < 1 / (1 + np.exp(-(x[:, 0] + 0.3 * x[:, 1] - 1.5 * x[:, 3] - 1)))).astype(float)
    data = [(i % 4, float(t), i, Vectors.dense(v.tolist())) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, ["fold", "label", "number", "features"]).repartition(3).cache()


def _point(**changed):
    return {"max_depth": 3, "learning_rate": 0.2, "n_estimators": 8, "gamma": 0, "min_child_weight": 5, "subsample": 1.0,
            "colsample_bytree": 1.0, **changed}


def _scored(inside, outside, points):
    got = {}
    for r in gbt_search.scores(inside, outside, points).collect():
        got.setdefault(r["point"], []).append(r["score"])
    return {i: sorted(v) for i, v in got.items()}


def test_batch_equals_single_fits(vectors):
    inside, outside = vectors.where("fold > 0"), vectors.where("fold = 0")
    points = [_point(), _point(n_estimators=3), _point(max_depth=2, gamma=0.02), _point(learning_rate=0.05, min_child_weight=20)]
    assert len(gbt_search.fits_of(points)) == 3
    got = _scored(inside, outside, points)
    for i, p in enumerate(points):
        single = models.estimator("gbt", p, 0).fit(inside)
        want = models.prefix_margins(single, [p["n_estimators"]], outside).collect()
        assert got[i] == pytest.approx(sorted(r[f"m_{p['n_estimators']}"] for r in want), abs=1e-5), p


def test_passes_equal_fits_of_a_task(vectors, monkeypatch):
    inside, outside = vectors.where("fold > 0"), vectors.where("fold = 0")
    points = [_point(subsample=0.6, colsample_bytree=0.6, min_child_weight=1, n_estimators=6), _point(max_depth=1, n_estimators=2),
              _point(subsample=0.6, colsample_bytree=0.6, min_child_weight=1, n_estimators=3), _point(gamma=5.0, n_estimators=2)]
    alone = _scored(inside, outside, points)
    monkeypatch.setattr(gbt_search, "FEW_ROWS", 0)
    monkeypatch.setattr(gbt_search, "KEPT_ROUNDS", 2)
    assert _scored(inside.repartition(5), outside.repartition(2), points) == alone
    assert len(set(alone[0])) > 20 and len(set(alone[3])) == 1


def test_draws():
    number = np.arange(100_000)
    share = [gbt_search.drawn_rows(number, t, 0.6) for t in (0, 1)]
    assert [s.mean() for s in share] == pytest.approx([0.6, 0.6], abs=0.01)
    assert (share[0] & share[1]).mean() == pytest.approx(0.36, abs=0.01)
    columns = gbt_search.drawn_columns(np.arange(5_000), 3, 0.6, 9)
    assert set(columns.sum(axis=1)) == {6} and columns.mean(axis=0) == pytest.approx(np.full(9, 6 / 9), abs=0.03)


def test_borders_of_many_values_follow_the_rows(spark, monkeypatch):
    values = np.random.default_rng(2).normal(0, 1, 4000)
    rows = spark.createDataFrame([(bool(i % 10), [float(v), float(i % 2), float("nan")]) for i, v in enumerate(values)],
                                 "inside boolean, x array<double>")
    fine = gbt_search.codes_of(rows)
    monkeypatch.setattr(gbt_search, "CELLS", 1000)
    coarse = gbt_search.codes_of(rows)
    mine = values[np.arange(4000) % 10 > 0]
    for codes, off in ((fine, 0.001), (coarse, 0.003)):
        assert codes.first.tolist() == [0, 32, 34, 35] and codes.borders[1].tolist() == [0.5]
        assert [(mine <= b).mean() for b in codes.borders[0]] == pytest.approx([i / 32 for i in range(1, 32)], abs=off)


@pytest.mark.parametrize("few", [0, 300_000])
def test_model_of_a_point_is_a_spark_model(spark, vectors, monkeypatch, few):
    monkeypatch.setattr(gbt_search, "FEW_ROWS", few)
    inside, outside = vectors.where("fold > 0"), vectors.where("fold = 0")
    point = _point(n_estimators=3)
    path = shared_path(spark, "gbt_batch")
    gbt_search.PointFit(point).fit(inside).write().save(path)
    model, single = GBTClassificationModel.load(path), models.estimator("gbt", point, 0).fit(inside)
    assert model.treeWeights == single.treeWeights and model.numFeatures == single.numFeatures
    assert model.featureImportances.toArray() == pytest.approx(single.featureImportances.toArray(), abs=1e-5)
    got, want = ([r["rawPrediction"][1] for r in m.transform(outside).orderBy("number").collect()] for m in (model, single))
    assert got == pytest.approx(want, abs=1e-5)
    drawn = _point(n_estimators=3, subsample=0.6, colsample_bytree=0.6, min_child_weight=1)
    margins = gbt_search.PointFit(drawn).fit(inside).transform(outside).collect()
    assert sorted(r["rawPrediction"][1] for r in margins) == pytest.approx(_scored(inside, outside, [drawn])[0])
