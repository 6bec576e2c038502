"""Logistic regression for all points of a search, on all folds, in one set of passes.

The objective of a model is C * sum of log losses + penalty, with the intercept
as the weight of a constant column that is penalised like any other, as in the
source solver.  Each pass over the rows evaluates every open model once: a task
adds up losses, gradients and Hessians of its rows, and one shuffle keyed by
model adds up the tasks.  The driver holds models x columns**2 numbers and takes
the next step: a Newton step for l2, a proximal Newton step (the minimum of the
local quadratic) for l1, halved until the objective falls enough.
Converged models leave the passes.

Rows keep one encoding.  A fold's own scaling is an affine change of the scaled
columns, taken from per-fold sums; a category that a fold's training rows lack
is a column of zeros there, so its weight stays 0, as if it were unseen.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators.monitor import grouped_auc
from churnlake.session import checkpoint

ALL_ROWS = -1           # fold of a model that is fitted on every row
MAX_PASSES = 200
ROUNDS, SWEEPS = 60, 5  # of one l1 step; what is left of it is done in the next pass
TOLERANCE = 1e-7        # largest step of a converged model
GAIN = 1e-11            # or its largest expected fall of the objective, as a share of it


class Scaling(NamedTuple):
    """Per fold (its training rows): mean and 1 / sample deviation of the first columns."""

    mean: dict[int, np.ndarray]
    inverse: dict[int, np.ndarray]


def design_rows(encoded: DataFrame, features: str = "features") -> DataFrame:
    """(fold, label, x) written to the shared folder: what every pass reads."""
    return checkpoint(encoded.select(F.col("fold").cast("int"), F.col("label").cast("double"),
                                     vector_to_array(F.col(features)).alias("x")))


def fold_scaling(rows: DataFrame, n_scaled: int, folds: int) -> Scaling:
    """Means and deviations of the first ``n_scaled`` columns on the rows outside each fold, in one aggregation."""
    x = [F.get("x", F.lit(j)) for j in range(n_scaled)]
    sums = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in x]).alias("s"),
                                    F.array(*[F.sum(c * c) for c in x]).alias("q")).collect()
    mean, inverse = {ALL_ROWS: np.zeros(n_scaled)}, {ALL_ROWS: np.ones(n_scaled)}
    for k in range(folds):
        mine = [r for r in sums if r["fold"] != k]
        n = sum(r["n"] for r in mine)
        s, q = (np.sum([r[c] for r in mine], axis=0) if mine else np.zeros(n_scaled) for c in ("s", "q"))
        m = s / max(n, 1)
        deviation = np.sqrt(np.maximum(q - n * m * m, 0) / max(n - 1, 1))
        mean[k] = m
        inverse[k] = np.divide(1.0, deviation, out=np.zeros(n_scaled), where=deviation > 1e-12)
    return Scaling(mean, inverse)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    fold, label, x = batch.columns
    return fold.to_numpy(zero_copy_only=False), label.to_numpy(zero_copy_only=False), \
        x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _scaled(x: np.ndarray, fold: int, scaling: Scaling) -> np.ndarray:
    """The fold's view of the rows, with the constant column last."""
    n = len(scaling.mean[fold])
    return np.column_stack([(x[:, :n] - scaling.mean[fold]) * scaling.inverse[fold], x[:, n:], np.ones(len(x))])


def _evaluate(models: list[tuple[int, int]], weights: np.ndarray, scaling: Scaling):
    """Per task: (model, loss, grad, hess) of ``models``, (model, fold), at ``weights``."""
    by_fold: dict[int, list[int]] = {}
    for i, (_, fold) in enumerate(models):
        by_fold.setdefault(fold, []).append(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = weights.shape[1]
        loss, grad, hess = np.zeros(len(models)), np.zeros((len(models), d)), np.zeros((len(models), d, d))
        for batch in batches:
            if not batch.num_rows:
                continue
            own, y, x = _columns(batch)
            for fold, places in by_fold.items():
                mine = own != fold
                v, t = _scaled(x[mine], fold, scaling), y[mine]
                z = v @ weights[places].T
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                loss[places] += (np.logaddexp(0, z) - t[:, None] * z).sum(axis=0)
                grad[places] += (p - t[:, None]).T @ v
                curve = p * (1 - p)
                for j, i in enumerate(places):
                    hess[i] += v.T @ (v * curve[:, j:j + 1])
        yield pa.RecordBatch.from_pydict({
            "model": pa.array([m for m, _ in models], pa.int32()), "loss": pa.array(loss),
            "grad": pa.array(list(grad), pa.list_(pa.float64())),
            "hess": pa.array([h.ravel() for h in hess], pa.list_(pa.float64()))})

    return run


def _added(parts: pd.DataFrame) -> pd.DataFrame:
    """One model's sums over all tasks."""
    return pd.DataFrame({"model": parts["model"].iloc[:1], "loss": [parts["loss"].sum()],
                         "grad": [np.sum(np.stack(parts["grad"].to_numpy()), axis=0)],
                         "hess": [np.sum(np.stack(parts["hess"].to_numpy()), axis=0)]})


_SUMS = "model int, loss double, grad array<double>, hess array<double>"


def _sweep(w: np.ndarray, grad: np.ndarray, hess: np.ndarray, d: np.ndarray, moved: np.ndarray) -> float:
    """One round of coordinate descent on all models, in place (moved: hess @ d); the largest step."""
    largest = 0.0
    for j in range(w.shape[1]):
        curve = np.maximum(hess[:, j, j], 1e-12)
        slope = grad[:, j] + moved[:, j]
        at = w[:, j] + d[:, j] - slope / curve
        new = np.sign(at) * np.maximum(np.abs(at) - 1 / curve, 0) - w[:, j]
        step = new - d[:, j]
        d[:, j] = new
        moved += hess[:, :, j] * step[:, None]
        largest = max(largest, float(np.abs(step).max()))
    return largest


def _to_orthant_minimum(at: np.ndarray, slope: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """From ``at`` (slope: of the quadratic there) to the minimum over its non-zero weights.  A step goes as far as
    the first sign change, so it only descends; the weight that would change its sign becomes 0 and the next step does
    without it.  Where columns depend on each other the quadratic is flat along some directions; the penalty falls
    along these until a weight is 0."""
    start, at = at, at.copy()
    for _ in range(len(at)):
        on = np.flatnonzero(at)
        if not len(on):
            break
        part = hess[np.ix_(on, on)]
        down = -(slope[on] + hess[on] @ (at - start) + np.sign(at[on]))
        step = np.linalg.lstsq(part, down, rcond=1e-11)[0]
        flat = down - part @ step
        if np.abs(flat).max() > 1e-6:
            step, most = flat, np.inf
        else:
            most = 1.0
        crosses = at[on] * step < 0
        reach = np.where(crosses, -at[on] / np.where(crosses, step, 1.0), np.inf)
        t = min(most, float(reach.min()))
        if not np.isfinite(t):
            break
        at[on] += t * step
        at[on[reach <= t]] = 0.0
        if t == most:
            break
    return at


def _l1_direction(w: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Minimum over d of grad.d + d.hess.d/2 + |w + d|, for all models at once: coordinate descent finds which
    weights are 0, and the others go to their minimum directly, which descent alone nears slowly where columns
    depend on each other."""
    hess = hess + 1e-10 * np.eye(w.shape[1])
    d = np.zeros_like(w)
    for _ in range(ROUNDS):
        moved = np.einsum("mij,mj->mi", hess, d)
        for _ in range(SWEEPS):
            largest = _sweep(w, grad, hess, d, moved)
            if largest < TOLERANCE / 100:
                return d
        for i in range(len(w)):
            d[i] = _to_orthant_minimum(w[i] + d[i], grad[i] + hess[i] @ d[i], hess[i]) - w[i]
    return d


def _penalty(w: np.ndarray, l1: np.ndarray) -> np.ndarray:
    return np.where(l1, np.abs(w).sum(axis=1), 0.5 * (w * w).sum(axis=1))


def fit_batch(rows: DataFrame, points: list[dict], folds: list[int], scaling: Scaling) -> np.ndarray:
    """(folds, points, columns + 1) weights, the intercept last: one model per fold and point, on the rows
    outside the fold (``ALL_ROWS``: on every row)."""
    models = [(i, k, p) for i, (k, p) in enumerate((k, p) for k in folds for p in points)]
    width = rows.select(F.size("x")).first()
    d = (width[0] if width else 0) + 1
    c = np.array([p["C"] for _, _, p in models], float)
    l1 = np.array([p["penalty"] == "l1" for _, _, p in models])
    w = np.zeros((len(models), d))
    direction, step = np.zeros_like(w), np.zeros(len(models))
    objective, expected = np.full(len(models), np.inf), np.zeros(len(models))
    open_ = np.ones(len(models), bool)
    for _ in range(MAX_PASSES):
        at = np.flatnonzero(open_)
        if not len(at):
            break
        tried = w + step[:, None] * direction
        parts = rows.mapInArrow(_evaluate([(int(i), models[i][1]) for i in at], tried[at], scaling), _SUMS)
        sums = {r["model"]: r for r in parts.groupBy("model").applyInPandas(_added, _SUMS).collect()}
        loss, grad = np.zeros(len(at)), np.zeros((len(at), d))
        hess = np.zeros((len(at), d, d))
        for j, i in enumerate(at):
            loss[j], grad[j], hess[j] = sums[i]["loss"], sums[i]["grad"], np.reshape(sums[i]["hess"], (d, d))
        loss, grad, hess = c[at] * loss, c[at][:, None] * grad, c[at][:, None, None] * hess
        value = loss + _penalty(tried[at], l1[at])
        fell = value <= objective[at] + 1e-4 * step[at] * expected[at] + 1e-12 * np.abs(value)
        back = at[~fell]
        step[back] /= 2
        open_[back[step[back] < 1e-10]] = False
        here = np.flatnonzero(fell)
        if not len(here):
            continue
        on = at[here]
        w[on], objective[on] = tried[on], value[here]
        new = np.zeros((len(here), d))
        first = l1[on]
        if first.any():
            new[first] = _l1_direction(w[on[first]], grad[here[first]], hess[here[first]])
        if (~first).any():
            g = grad[here[~first]] + w[on[~first]]
            new[~first] = -np.linalg.solve(hess[here[~first]] + np.eye(d), g[:, :, None])[:, :, 0]
        slope = (grad[here] * new).sum(axis=1)
        expected[on] = np.where(first, slope + _penalty(w[on] + new, l1[on]) - _penalty(w[on], l1[on]),
                                slope + (w[on] * new).sum(axis=1))
        direction[on], step[on] = new, 1.0
        open_[on[(np.abs(new).max(axis=1) < TOLERANCE) | (-expected[on] <= GAIN * np.abs(objective[on]))]] = False
    return w.reshape(len(folds), len(points), d)


def fold_aucs(rows: DataFrame, weights: np.ndarray, scaling: Scaling) -> DataFrame:
    """(fold, point, auc): exact AUC of every point on the rows of each fold, from one pass over the rows."""
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, y, x = _columns(batch)
            for k in range(len(weights)):
                mine = own == k
                if mine.any():
                    z = _scaled(x[mine], k, scaling) @ weights[k].T
                    n, p = z.shape
                    yield pa.RecordBatch.from_pydict({
                        "fold": pa.array(np.full(n * p, k), pa.int32()), "point": pa.array(np.tile(np.arange(p), n), pa.int32()),
                        "label": pa.array(np.repeat(y[mine], p)), "score": pa.array(z.ravel())})

    long = rows.mapInArrow(scores, "fold int, point int, label double, score double")
    return grouped_auc(long, ["fold", "point"], "label", "score", digits=None)


def mean_aucs(rows: DataFrame, points: list[dict], folds: int, scaling: Scaling) -> list[float]:
    """Mean over the folds of each point's AUC; folds with one class are left out."""
    weights = fit_batch(rows, points, list(range(folds)), scaling)
    found: dict[int, list[float]] = {}
    for r in fold_aucs(rows, weights, scaling).collect():
        if r["auc"] is not None:
            found.setdefault(r["point"], []).append(r["auc"])
    return [float(np.mean(found[i])) if found.get(i) else 0.0 for i in range(len(points))]


def as_model(spark: SparkSession, weights: np.ndarray) -> LogisticRegressionModel:
    """Fitted weights (the intercept last) as a Spark ML model, for scoring and saving."""
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "logreg_batch", _py2java(spark.sparkContext, Vectors.dense(weights[:-1].tolist())), float(weights[-1]))
    return LogisticRegressionModel(made).setFeaturesCol("features")
