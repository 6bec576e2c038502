"""End-to-end jobs: monthly backfill, training, batch scoring, monitoring.

Each job is one Spark application step over Hive-partitioned tables in a
datamart root (a shared file system or object store path):

    <root>/bronze/<feed>/Snapshot_Date=.../*.csv
    <root>/silver/<feed>/Snapshot_Date=.../*.parquet
    <root>/gold/feature_store/..., <root>/gold/label_store/...
    <root>/gold/model_predictions/model_name=.../snapshot_date=.../
    <root>/monitoring/<table>/
    <models>/<model_name>/<train_date>/{pipeline, impute_stats}

A backfill over any number of months is ONE job per layer (not one per
month): partitions are replaced with dynamic overwrite, so re-running a month
is idempotent and leaves the others alone.  Row counts per step are read
back from the written partitions (Parquet counts come from file metadata).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators import impute, monitor, monitor_state, stores
from churnlake.operators.clean import CLEANERS
from churnlake.plans import models
from churnlake.schema import CATEGORICAL_FEATURES, GOLD_FEATURE_SCHEMA, NUMERIC_FEATURES, SILVER_SCHEMAS
from churnlake.sources import feeds

FEEDS = ["features", "meta", "labels"]


def _p(root: str, *parts: str) -> str:
    return os.path.join(root, *parts)


def _written_rows(spark: SparkSession, path: str, snapshots: list[str] | None, feed: str | None = None) -> int:
    """Rows now in the written partitions (Parquet: from file metadata; bronze CSV: a scan of those months).

    Not ``DataFrame.observe``: on Spark 4.1 an ``Observation`` initialises the
    session's observation manager, after which a fitted LogisticRegression model
    (its training summary holds the session) can no longer be serialised into tasks.
    """
    if feed is not None:
        df = feeds.read_bronze(spark, path, feed)
        if snapshots:
            df = df.where(F.col("Snapshot_Date").isin(snapshots))
    else:
        df = feeds.read_store(spark, path)
        if snapshots:
            df = df.where(F.col("Snapshot_Date").isin([F.to_date(F.lit(s)) for s in snapshots]))
    return df.count()


class MissingUpstream(ValueError):
    """Listed months that a feed did not deliver."""

    def __init__(self, gaps: list[tuple[str, str]]):
        super().__init__(f"no bronze rows for {gaps}")
        self.gaps = gaps


def missing_upstream(spark: SparkSession, root: str, snapshots: list[str]) -> list[tuple[str, str]]:
    """(feed, snapshot) of the listed months without bronze rows; one count of a feed's listed partitions each."""
    gaps = []
    for feed in FEEDS:
        path = _p(root, "bronze", feed)
        have: set[str] = set()
        if feeds.has_files(spark, path, "*.csv"):
            rows = feeds.read_bronze(spark, path, feed).where(F.col("Snapshot_Date").isin(snapshots))
            have = {r[0] for r in rows.groupBy("Snapshot_Date").agg(F.count(F.lit(1))).collect()}
        gaps += [(feed, s) for s in snapshots if s not in have]
    return gaps


def backfill(spark: SparkSession, raw: dict[str, DataFrame], root: str,
             snapshots: list[str] | None = None, on_missing: str = "skip") -> dict[str, int]:
    """P1 + P2 + P7: raw feeds -> bronze CSV -> silver Parquet -> gold stores, all listed months at once.

    ``raw`` maps feed name to a raw DataFrame (e.g. ``feeds.read_raw_csv``).
    Returns rows written per table.  A table with no rows for a month simply
    has no partition for it (the readiness report lists such gaps); with
    ``on_missing="raise"`` a listed month that a feed did not deliver stops the
    run after bronze, before anything is built on it (``MissingUpstream``).
    """
    if on_missing not in ("skip", "raise"):
        raise ValueError(on_missing)
    counts: dict[str, int] = {}
    for feed in FEEDS:
        path = _p(root, "bronze", feed)
        feeds.write_bronze(feeds.bronze(raw[feed], snapshots), path)
        counts[f"bronze/{feed}"] = _written_rows(spark, path, snapshots, feed)
    if on_missing == "raise" and snapshots and (gaps := missing_upstream(spark, root, snapshots)):
        raise MissingUpstream(gaps)
    silver = {}
    for feed in FEEDS:
        bronze = feeds.read_bronze(spark, _p(root, "bronze", feed), feed)
        if snapshots:
            bronze = bronze.where(F.col("Snapshot_Date").isin(snapshots))  # partition pruning
        path = _p(root, "silver", feed)
        feeds.write_partitioned(CLEANERS[feed](bronze), path)
        counts[f"silver/{feed}"] = _written_rows(spark, path, snapshots)
        silver[feed] = feeds.read_store(spark, path, schema=SILVER_SCHEMAS[feed])
        if snapshots:
            silver[feed] = silver[feed].where(F.col("Snapshot_Date").isin([F.to_date(F.lit(s)) for s in snapshots]))
    path = _p(root, "gold", "feature_store")
    feeds.write_partitioned(stores.gold_feature_store(silver["features"], silver["meta"]), path)
    counts["gold/feature_store"] = _written_rows(spark, path, snapshots)
    path = _p(root, "gold", "label_store")
    feeds.write_partitioned(stores.gold_label_store(silver["labels"]), path)
    counts["gold/label_store"] = _written_rows(spark, path, snapshots)
    return counts


def gold_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return (feeds.read_store(spark, _p(root, "gold", "feature_store"), schema=GOLD_FEATURE_SCHEMA),
            feeds.read_store(spark, _p(root, "gold", "label_store"), schema=SILVER_SCHEMAS["labels"]))


def train(spark: SparkSession, root: str, train_date: str, model_root: str, kind: str = "gbt",
          draws: int = models.TREE_DRAWS, folds: int = models.FOLDS, tree_grid: dict | None = None,
          c_values: list[float] = models.LR_C_VALUES, penalties: list[str] = models.LR_PENALTIES) -> DataFrame:
    """P6: modelling set -> time split -> stratified split -> impute -> search -> evaluate -> save.

    Saves the best pipeline and the train-part imputation statistics under
    ``<model_root>/<kind>/<train_date>``; returns evaluation rows (train/test/oot).
    """
    features, labels = gold_tables(spark, root)
    mset = stores.modelling_set(labels, features, train_date)
    ts = stores.temporal_split(mset, train_date)
    tt = stores.stratified_split(ts.where(F.col("part") == "train_test").drop("part"))
    parts = tt.unionByName(ts.where(F.col("part") == "oot"))
    train_part = parts.where(F.col("part") == "train")
    med = impute.fit_medians(train_part, NUMERIC_FEATURES)
    mode = impute.fit_modes(train_part, CATEGORICAL_FEATURES)
    data = impute.fill_values(impute.fill_values(
        parts.select([F.col(c).cast("double").alias(c) if c in NUMERIC_FEATURES else F.col(c) for c in parts.columns]),
        {k: v for k, v in med.items() if v is not None}), mode).withColumn("label", F.col("Churn").cast("double"))
    data = data.cache()
    fit_on = data.where(F.col("part") == "train")
    points = models.lr_points(c_values, penalties) if kind == "lr" else models.tree_points(draws, grid=tree_grid)
    best = models.search(fit_on, kind, points, folds).model
    out = _p(model_root, kind, train_date)
    models.save(best, _p(out, "pipeline"))
    stats = [(c, "median", None if v is None else str(v)) for c, v in med.items()] + \
            [(c, "mode", v) for c, v in mode.items()]
    spark.createDataFrame(stats, "column_name string, kind string, value string").write.mode("overwrite").parquet(
        _p(out, "impute_stats"))
    result = models.evaluate(best, data, kind)
    data.unpersist()
    return result


def score(spark: SparkSession, root: str, model_dir: str, snapshot: str, model_name: str,
          stats_from: str = "train") -> DataFrame:
    """P4: score one snapshot of the gold feature store and write predictions (Parquet + CSV copy)."""
    features, _ = gold_tables(spark, root)
    snap = features.where(F.col("Snapshot_Date") == F.to_date(F.lit(snapshot)))  # partition pruning
    if stats_from == "batch":
        snap = impute.batch_impute(snap, NUMERIC_FEATURES, CATEGORICAL_FEATURES, "Snapshot_Date")
    else:
        rows = spark.read.parquet(_p(model_dir, "impute_stats")).collect()  # one row per feature column
        med = {r.column_name: float(r.value) for r in rows if r.kind == "median" and r.value is not None}
        mode = {r.column_name: r.value for r in rows if r.kind == "mode"}
        snap = impute.fill_values(impute.fill_values(snap.select(
            [F.col(c).cast("double").alias(c) if c in NUMERIC_FEATURES else F.col(c) for c in snap.columns]),
            med), mode)
    preds = models.score(models.load(_p(model_dir, "pipeline")), snap, model_name)
    out = _p(root, "gold", "model_predictions")
    feeds.write_predictions(preds, out, csv_copy=_p(root, "gold", "model_predictions_csv", model_name, snapshot))
    return feeds.read_predictions(spark, out, _p(root, "gold", "model_predictions_csv")).where(
        (F.col("model_name") == model_name) & (F.col("snapshot_date") == F.to_date(F.lit(snapshot))))


def run_monitoring(spark: SparkSession, root: str, model_name: str | None = None,
                   start: str | None = None, end: str | None = None, baseline: str | None = None) -> dict[str, str]:
    """P5: monthly AUC + summary, PSI report and KDE tables written under ``<root>/monitoring``.

    Scores come from the written predictions of ``model_name`` when given,
    else from the heuristic score.  ``start``/``end`` bound the months.
    """
    features, labels = gold_tables(spark, root)
    if start:
        features = features.where(F.col("Snapshot_Date") >= F.to_date(F.lit(start)))
    if end:
        features = features.where(F.col("Snapshot_Date") <= F.to_date(F.lit(end)))
    scores = None
    if model_name:
        preds = feeds.read_predictions(spark, _p(root, "gold", "model_predictions"), _p(root, "gold", "model_predictions_csv")).where(
            F.col("model_name") == model_name)
        scores = preds.select("customerID", F.col("snapshot_date").alias("Snapshot_Date"), "churn_probability")
    mon = monitor.monitoring_set(features, labels, scores)
    auc = monitor.monthly_auc(mon)
    tables = {
        "monthly_auc": auc,
        "auc_summary": monitor.auc_summary(monitor.monthly_auc(mon, digits=None)),
        "psi_report": monitor.psi_report(mon, baseline),
        "kde_scores": monitor.kde(mon, "churn_probability"),
        "kde_charges": monitor.kde(mon, "monthly_charges"),
    }
    paths = {}
    for name, df in tables.items():
        paths[name] = _p(root, "monitoring", name)
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def monitor_months(spark: SparkSession, root: str, months: list[str], baseline: str | None = None) -> dict[str, str]:
    """Incremental P5: the rows of ``months`` only are read; their histograms replace what is stored for these
    months, and the AUC and PSI reports are made from the stored state of all months."""
    features, labels = gold_tables(spark, root)
    days = [F.to_date(F.lit(m)) for m in months]
    mon = monitor.monitoring_set(features.where(F.col("Snapshot_Date").isin(days)), labels.where(F.col("Snapshot_Date").isin(days)))
    state_path = _p(root, "monitoring", "_state")
    monitor_state.update_state(monitor_state.histograms(mon), state_path)
    state = monitor_state.read_state(spark, state_path)
    paths = {}
    for name, df in {"monthly_auc": monitor_state.auc_from_state(state), "psi_report": monitor_state.psi_from_state(state, baseline)}.items():
        paths[name] = _p(root, "monitoring", name)
        df.write.mode("overwrite").parquet(paths[name])
    return paths
