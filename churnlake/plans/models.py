"""Model training, search, evaluation and persistence on Spark ML.

The training frame stays distributed (no toPandas): imputation statistics are
bounded aggregates, the encoders/scaler are Spark ML stages, and the search
fits them once per stratified fold, then every point on the fold's vectors.
"""

from __future__ import annotations

import itertools
import random
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators import impute
from churnlake.operators.monitor import grouped_auc
from churnlake.operators.ranking import exact_rank
from churnlake.operators.stores import split_hash
from churnlake.plans import gbt_search, lr_search
from churnlake.plans.features import feature_names, preprocessor
from churnlake.schema import CATEGORICAL_FEATURES, KEYS, NUMERIC_FEATURES
from churnlake.session import checkpoint

# --- fixed values: search spaces of the source training code ---
LR_C_VALUES = [0.01, 0.1, 1, 10, 100]
LR_PENALTIES = ["l1", "l2"]
TREE_GRID = {
    "max_depth": [3, 5, 7, 9],
    "learning_rate": [0.01, 0.1, 0.2],
    "n_estimators": [100, 200, 300],
    "gamma": [0, 0.1, 0.2],
    "min_child_weight": [1, 3, 5],
    "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0],
}
TREE_DRAWS, FOLDS, SEARCH_SEED = 50, 5, 42
# --- end of fixed values ---


def prepare(parts: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> DataFrame:
    """Impute with train medians/modes (bounded stats), add ``label`` (double)."""
    train = parts.where(F.col("part") == "train")
    out = impute.median_impute(parts, numeric, train)
    out = impute.mode_impute(out, categorical, train)
    return out.withColumn("label", F.col("Churn").cast("double"))


def stratified_folds(train: DataFrame, k: int = FOLDS, label_col: str = "label", seed: int = SEARCH_SEED,
                     number: str | None = None) -> DataFrame:
    """``fold`` = (rank within label in hash order) mod k: every fold holds each class evenly.  ``number``: the name
    of an added column, a hash of label and rank."""
    keyed = train.withColumn("_h", split_hash(seed))
    ranked = exact_rank(keyed, [label_col], ["_h", *KEYS], "_r")
    added = {number: F.xxhash64(label_col, "_r")} if number else {}
    return ranked.withColumns({"fold": (F.col("_r") % k).cast("int"), **added}).drop("_h", "_r")


def lr_estimator(n_train: int, C: float = 1.0, penalty: str = "l2", max_iter: int = 100) -> LogisticRegression:
    """Logistic regression; C of the summed-loss formulation maps to regParam = 1/(C·n), on the given columns."""
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, standardization=False,
                              regParam=1.0 / (C * n_train), elasticNetParam=1.0 if penalty == "l1" else 0.0)


def gbt_estimator(max_iter: int = 100, max_depth: int = 6, step: float = 0.3, seed: int = 42) -> GBTClassifier:
    """Boosted trees; the defaults are those of the library that the source code fits with."""
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                         stepSize=step, seed=seed)


def fit_pipeline(train: DataFrame, estimator, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> PipelineModel:
    return Pipeline(stages=[*preprocessor(numeric, categorical).getStages(), estimator]).fit(train)


def positive_probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("churn_probability", vector_to_array(F.col("probability"))[1])


def evaluate(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Per part: rows, exact AUC, accuracy, the confusion matrix (tn, fp, fn, tp), precision, recall and F1 of
    both classes, macro and weighted F1.  Every row is scored once; zero division gives 0."""
    scored = checkpoint(positive_probability(model.transform(df)).select(
        "part", F.col("label").cast("int").alias("actual_churn"), "churn_probability",
        F.col("prediction").cast("int").alias("prediction")))
    y, p = F.col("actual_churn"), F.col("prediction")
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    counts = scored.groupBy("part").agg(*[F.count_if((y == a) & (p == b)).alias(c) for c, (a, b) in cells.items()])
    tn, fp, fn, tp = [F.col(c) for c in cells]

    def share(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    def f1(right, wrong):
        return share(2 * right, 2 * right + wrong)

    f1_0, f1_1, total = f1(tn, fp + fn), f1(tp, fp + fn), tn + fp + fn + tp
    metrics = {
        "accuracy": share(tn + tp, total),
        "precision_1": share(tp, tp + fp), "recall_1": share(tp, tp + fn), "f1_1": f1_1,
        "precision_0": share(tn, tn + fn), "recall_0": share(tn, tn + fp), "f1_0": f1_0,
        "macro_f1": (f1_0 + f1_1) / 2, "weighted_f1": share(f1_0 * (tn + fp) + f1_1 * (fn + tp), total),
    }
    return grouped_auc(scored, ["part"]).join(counts, "part").select(
        F.lit(name).alias("model"), "part", "n", "positives", "auc", *cells,
        *[F.round(v, 6).alias(k) for k, v in metrics.items()])


def lr_points(c_values=LR_C_VALUES, penalties=LR_PENALTIES) -> list[dict]:
    return [{"C": c, "penalty": p} for c in c_values for p in penalties]


def tree_points(draws: int = TREE_DRAWS, seed: int = SEARCH_SEED, grid: dict | None = None) -> list[dict]:
    """Seeded sample of distinct points of the full tree grid."""
    grid = grid or TREE_GRID
    full = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(full, min(draws, len(full)))


def estimator(kind: str, point: dict, n_train: int):
    """The estimator of a search point; tree parameters are mapped to Spark's GBT."""
    if kind == "lr":
        return lr_estimator(n_train, max_iter=1000, **point)
    gbt = gbt_estimator(point["n_estimators"], point["max_depth"], point["learning_rate"])
    return (gbt.setMinInfoGain(float(point["gamma"])).setMinInstancesPerNode(point["min_child_weight"])
            .setSubsamplingRate(float(point["subsample"])).setFeatureSubsetStrategy(str(point["colsample_bytree"])))


class Search(NamedTuple):
    points: list[dict]
    mean_auc: list[float]
    model: PipelineModel     # the best point, fitted on all train rows


def search(train: DataFrame, kind: str, points: list[dict], folds: int = FOLDS) -> Search:
    """Cross-validated search on AUC over stratified folds; of equal points the first wins.

    Logistic regression: all points on all folds in one set of passes (``lr_search``).  Boosted trees: the
    encoders and the scaler are fitted once per fold, on the rows outside it, and all points are fitted together on
    the fold's vectors (``staged_aucs``).
    """
    if kind == "lr":
        return _lr_search(train, points, folds)
    folded = stratified_folds(train, folds, number="number").persist()
    total = [0.0] * len(points)
    for k in range(folds):
        fitted = preprocessor(NUMERIC_FEATURES, CATEGORICAL_FEATURES).fit(folded.where(F.col("fold") != k))
        vectors = fitted.transform(folded).select("fold", "label", "number", "features")
        inside, outside = vectors.where(F.col("fold") != k), vectors.where(F.col("fold") == k)
        for i, auc in staged_aucs(inside, outside, points).items():
            total[i] += auc
    mean = [t / folds for t in total]
    best = points[mean.index(max(mean))]
    model = fit_pipeline(folded, gbt_search.PointFit(best))
    folded.unpersist()
    return Search(points, mean, model)


def _lr_search(train: DataFrame, points: list[dict], folds: int) -> Search:
    folded = stratified_folds(train, folds)
    fitted = preprocessor(NUMERIC_FEATURES, CATEGORICAL_FEATURES).fit(folded)
    rows = lr_search.design_rows(fitted.transform(folded))
    scaling = lr_search.fold_scaling(rows, len(NUMERIC_FEATURES), folds)
    mean = lr_search.mean_aucs(rows, points, folds, scaling)
    best = points[mean.index(max(mean))]
    weights = lr_search.fit_batch(rows, [best], [lr_search.ALL_ROWS], scaling)[0, 0]
    return Search(points, mean, PipelineModel([*fitted.stages, lr_search.as_model(train.sparkSession, weights)]))


def prefix_margins(model, sizes: list[int], scored: DataFrame) -> DataFrame:
    """Adds ``m_<n>`` for each number of trees: the margin of the first n trees of one boosted fit.

    The ensemble is cut into the stretches between the sizes, so every tree is evaluated once and a prefix is
    a sum of stretches.
    """
    gateway = scored.sparkSession.sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees, weights = model._java_obj.trees(), model.treeWeights

    def stretch(kind, values):
        out = gateway.new_array(kind, len(values))
        for i, v in enumerate(values):
            out[i] = v
        return out

    out, so_far, start = scored, F.lit(0.0), 0
    for n in sorted(set(sizes)):
        part = ml.classification.GBTClassificationModel(
            f"gbt_{start}_{n}", stretch(ml.regression.DecisionTreeRegressionModel, [trees[i] for i in range(start, n)]),
            stretch(gateway.jvm.double, weights[start:n]), model.numFeatures, 2)
        piece = (GBTClassificationModel(part).setFeaturesCol("features").setRawPredictionCol(f"_raw_{n}")
                 .setProbabilityCol("").setPredictionCol(""))
        out = piece.transform(out)
        so_far = so_far + vector_to_array(F.col(f"_raw_{n}"))[1]
        out = out.withColumn(f"m_{n}", so_far).drop(f"_raw_{n}")
        so_far, start = F.col(f"m_{n}"), n
    return out


def staged_aucs(inside: DataFrame, outside: DataFrame, points: list[dict]) -> dict[int, float]:
    """AUC on ``outside`` of each point, by its place; all points are fitted together (``gbt_search``), those that
    differ only in their number of trees by one fit."""
    scored = gbt_search.scores(inside, outside, points)
    aucs = {r["point"]: r["auc"] for r in grouped_auc(scored, ["point"], "label", "score", digits=None).collect()}
    return {i: 0.5 if aucs.get(i) is None else aucs[i] for i in range(len(points))}


def search_table(spark: SparkSession, found: Search) -> DataFrame:
    """One row per parameter point: its parameters (as text), mean CV AUC, and the best flag."""
    best = found.mean_auc.index(max(found.mean_auc))
    rows = [(", ".join(f"{k}={v}" for k, v in sorted(point.items())), round(auc, 6), i == best)
            for i, (point, auc) in enumerate(zip(found.points, found.mean_auc))]
    return spark.createDataFrame(rows, "params string, mean_auc double, best boolean")


def importance(model: PipelineModel, kind: str) -> DataFrame:
    """Feature importance by encoded name: |coefficient| (LR) or tree importance (GBT)."""
    names = feature_names(model, NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    last = model.stages[-1]
    values = ([abs(float(v)) for v in last.coefficients.toArray()] if kind == "lr"
              else [float(v) for v in last.featureImportances.toArray()])
    rows = [(n, float(round(v, 6))) for n, v in zip(names, values)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def score(model: PipelineModel, features: DataFrame, model_name: str) -> DataFrame:
    """Batch scoring: ids travel with their rows; prediction and positive-class probability kept."""
    scored = positive_probability(model.transform(features))
    return scored.select("customerID", F.col("Snapshot_Date").alias("snapshot_date"),
                         F.lit(model_name).alias("model_name"),
                         F.col("prediction").cast("int").alias("model_predictions"), "churn_probability")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
