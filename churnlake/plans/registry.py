"""Named DataFrame jobs over the driver's tables, one per inventory item group.

Each callable takes (spark, sf_dir) and returns a DataFrame; building one may
write the stores it reads and run ranking or fitting jobs.  Metrics are
rounded to 6 places and counts are bigint so two engines compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators import explore, impute, monitor, quality, stores
from churnlake.operators.clean import cleaning_funnel
from churnlake.plans import features as feat
from churnlake.plans import models
from churnlake.plans.datasets import Datamart, written
from churnlake.schema import (
    BINARY_COLUMNS, CATEGORICAL_FEATURES, CONSTANT_FILLS, NUMERIC_FEATURES, RAW_FEATURE_COLUMNS,
)
from churnlake.session import session_key, shared_path
from churnlake.sources import feeds

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def job(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _dm(spark: SparkSession, sf_dir: str, planted: bool = False) -> Datamart:
    return Datamart(spark, sf_dir, planted=planted)


# ---- silver / gold -------------------------------------------------------

def _written_anew(spark, name, df):
    """The job that fills a store: ``df`` written in partitions and read back."""
    return feeds.read_store(spark, written(spark, name, df), schema=df.schema)


for _feed in ["features", "meta", "labels"]:
    REGISTRY[f"silver_{_feed}"] = lambda spark, sf_dir, feed=_feed: _written_anew(
        spark, f"silver_{feed}", _dm(spark, sf_dir).silver_plan[feed])


@job("gold_feature_store")
def gold_feature_store(spark, sf_dir):
    return _written_anew(spark, "gold_feature_store", _dm(spark, sf_dir).gold_features_plan)


@job("gold_label_store")
def gold_label_store(spark, sf_dir):
    return _written_anew(spark, "gold_label_store", _dm(spark, sf_dir).gold_labels_plan)


# ---- exploration -----------------------------------------------------------

@job("churn_distribution")
def churn_distribution(spark, sf_dir):
    return explore.churn_distribution(_dm(spark, sf_dir).eda)


for _dim, _name in [("Contract", "contract"), ("InternetService", "internet"), ("TechSupport", "techsupport"),
                    ("PaymentMethod", "payment"), ("OnlineSecurity", "onlinesecurity")]:
    def _make(dim):
        return lambda spark, sf_dir: explore.crosstab(_dm(spark, sf_dir).eda, dim)
    REGISTRY[f"crosstab_{_name}"] = _make(_dim)


@job("rate_by_gender")
def rate_by_gender(spark, sf_dir):
    return explore.rate_by_gender(_dm(spark, sf_dir).eda)


@job("monthly_rate")
def monthly_rate(spark, sf_dir):
    return explore.monthly_rate(_dm(spark, sf_dir).eda)


@job("tenure_bin_churn")
def tenure_bin_churn(spark, sf_dir):
    return explore.tenure_bin_churn(_dm(spark, sf_dir).eda)


@job("snapshot_dates")
def snapshot_dates(spark, sf_dir):
    return explore.snapshot_dates(_dm(spark, sf_dir).gold_labels)


# ---- monitoring ----------------------------------------------------------------

# Scenario months of the source monitor (April..July), mapped to the fixture calendar.
SCENARIO_MONTHS = [("Apr", "1998-04-15"), ("May", "1998-05-15"), ("Jun", "1998-06-15"), ("Jul", "1998-07-15")]


def _mon(spark, sf_dir):
    dm = _dm(spark, sf_dir)
    mon = monitor.monitoring_set(dm.gold_features, dm.gold_labels)
    # scores compared at 1e-9, here and in the SQL, so that ties are the same in both engines
    return mon.withColumn("churn_probability", F.round("churn_probability", 9))


def _with_prediction(mon):
    return mon.withColumn("prediction", (F.col("churn_probability") > 0.5).cast("int"))


@job("heuristic_score")
def heuristic_score(spark, sf_dir):
    return _mon(spark, sf_dir).select("customerID", "snapshot_date", F.round("churn_probability", 6)
                                      .alias("churn_probability"))


@job("target_list")
def target_list(spark, sf_dir):
    from churnlake.schema import TARGET_CUT
    return _mon(spark, sf_dir).where(F.col("churn_probability") > TARGET_CUT).select(
        "customerID", "snapshot_date", F.round("churn_probability", 6).alias("churn_probability"))


@job("scenario_expand")
def scenario_expand(spark, sf_dir):
    return monitor.scenario_expand(_mon(spark, sf_dir), SCENARIO_MONTHS)


@job("pred_truth_join")
def pred_truth_join(spark, sf_dir):
    dm = _dm(spark, sf_dir)
    scored = monitor.with_heuristic_score(dm.gold_features)
    preds = monitor.predictions_from_scores(scored, "heuristic").withColumn(
        "churn_probability", F.round("churn_probability", 6))
    return monitor.pred_truth_join(preds, dm.silver["features"], dm.gold_labels)


@job("customer_only_join")
def customer_only_join(spark, sf_dir):
    dm = _dm(spark, sf_dir)
    return monitor.customer_only_fanout(dm.silver["features"], dm.gold_labels)


@job("label_test_yes")
def label_test_yes(spark, sf_dir):
    return monitor.label_test_yes(_dm(spark, sf_dir).raw["labels"])


@job("monthly_auc")
def monthly_auc(spark, sf_dir):
    return monitor.monthly_auc(_mon(spark, sf_dir))


@job("auc_summary")
def auc_summary(spark, sf_dir):
    return monitor.auc_summary(monitor.monthly_auc(_mon(spark, sf_dir), digits=None))


@job("deciles")
def deciles(spark, sf_dir):
    return monitor.deciles(_mon(spark, sf_dir))


@job("psi_report")
def psi_report(spark, sf_dir):
    return monitor.psi_report(_mon(spark, sf_dir))


@job("kde_scores")
def kde_scores(spark, sf_dir):
    return monitor.kde(_mon(spark, sf_dir), "churn_probability")


@job("kde_charges")
def kde_charges(spark, sf_dir):
    return monitor.kde(_mon(spark, sf_dir), "monthly_charges")


@job("kde_binned_charges")
def kde_binned_charges(spark, sf_dir):
    return monitor.kde_binned(monitor.long_features(_mon(spark, sf_dir), ["monthly_charges"]))


# months whose monitoring state is stored first; the others come in a second update
STATE_CUT = "1996-01-01"


def _state(spark, sf_dir, make, schema):
    """State of all months, stored in two updates, of which the second repeats one month."""
    from churnlake.operators import monitor_state
    mon, path, cut = _mon(spark, sf_dir), shared_path(spark, "monitor_state"), F.to_date(F.lit(STATE_CUT))
    monitor_state.update_state(make(mon.where(F.col("month_start") <= cut)), path)
    monitor_state.update_state(make(mon.where(F.col("month_start") >= cut)), path)
    return monitor_state.read_state(spark, path, schema)


@job("psi_incremental")
def psi_incremental(spark, sf_dir):
    from churnlake.operators import monitor_state as ms
    return ms.psi_from_state(_state(spark, sf_dir, ms.histograms, ms.HISTOGRAM_SCHEMA))


@job("auc_incremental")
def auc_incremental(spark, sf_dir):
    from churnlake.operators import monitor_state as ms
    return ms.auc_from_state(_state(spark, sf_dir, ms.histograms, ms.HISTOGRAM_SCHEMA))


@job("psi_sketches")
def psi_sketches(spark, sf_dir):
    """PSI from one bounded sketch per feature and month (approximate, so compared with the exact form in tests)."""
    from churnlake.operators import monitor_state as ms
    return ms.psi_from_sketches(_state(spark, sf_dir, ms.sketches, ms.SKETCH_SCHEMA))


@job("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    return monitor.confusion_matrix(_with_prediction(_mon(spark, sf_dir)))


@job("classification_report")
def classification_report(spark, sf_dir):
    return monitor.classification_report(_with_prediction(_mon(spark, sf_dir)))


@job("accuracy_f1")
def accuracy_f1(spark, sf_dir):
    return monitor.accuracy_f1(_with_prediction(_mon(spark, sf_dir)))


# ---- sources / quality ------------------------------------------------------------

TRAIN_DATE = "1998-08-01"  # model train date on the fixture calendar (source: 2024-08-01)


def _bronze_roundtrip(spark, sf_dir, feed):
    """Ingest every parsable snapshot of the raw feed into the partitioned bronze CSV, read it back."""
    raw = _dm(spark, sf_dir).raw[feed]
    path = shared_path(spark, f"bronze_{feed}")
    feeds.write_bronze(feeds.bronze(raw), path)
    return feeds.read_bronze(spark, path, feed)


for _feed in ["features", "meta", "labels"]:
    REGISTRY[f"bronze_snapshot_{_feed}"] = (lambda f: lambda spark, sf_dir: _bronze_roundtrip(spark, sf_dir, f))(_feed)


def _layer_tables(dm):
    return {
        ("raw", "features"): dm.raw["features"], ("raw", "meta"): dm.raw["meta"],
        ("raw", "labels"): dm.raw["labels"],
        ("silver", "features"): dm.silver["features"], ("silver", "meta"): dm.silver["meta"],
        ("silver", "labels"): dm.silver["labels"],
        ("gold", "feature_store"): dm.gold_features, ("gold", "label_store"): dm.gold_labels,
    }


@job("readiness_gaps")
def readiness_gaps(spark, sf_dir):
    dm = _dm(spark, sf_dir)
    return quality.readiness_gaps(_layer_tables(dm), feeds.month_calendar(dm.raw["features"]))


@job("snapshot_row_counts")
def snapshot_row_counts(spark, sf_dir):
    return quality.snapshot_row_counts(_layer_tables(_dm(spark, sf_dir)))


@job("layer_funnel")
def layer_funnel(spark, sf_dir):
    dm = _dm(spark, sf_dir)
    names = ("features", "meta", "labels")
    return quality.layer_funnel({f: dm.raw[f] for f in names}, {f: dm.silver[f] for f in names})


@job("preview_rows")
def preview_rows(spark, sf_dir):
    return quality.preview(_layer_tables(_dm(spark, sf_dir)), 5).drop("row_md5")


# ---- change-driven backfill -------------------------------------------------------------

def _deliveries(dm):
    """Two deliveries of the raw feeds: the second brings new months of features, changed rows in May, other file
    layouts, and lacks the meta rows of 1993."""
    raw = dm.raw
    date, number = F.col("Snapshot_Date"), F.substring("customerID", 2, 12).cast("int")
    first = {"features": raw["features"].where(date < "1998-06-01"), "meta": raw["meta"], "labels": raw["labels"]}
    tenure = F.when((F.substring(date, 6, 2) == "05") & (number % 10 == 0), F.lit("1")).otherwise(F.col("tenure"))
    second = {"features": raw["features"].withColumn("tenure", tenure), "meta": raw["meta"].where(~date.startswith("1993")),
              "labels": raw["labels"].repartition(3)}
    last = raw["features"].agg(F.add_months(F.trunc(F.max(F.to_date(date)), "month"), 1).alias("snapshot_date"))
    return first, second, feeds.month_calendar(raw["features"]).unionByName(last)


@job("backfill_plan")
def backfill_plan(spark, sf_dir):
    """What a backfill of the second delivery has to rebuild after the first was built."""
    from churnlake.plans.changes import backfill_plan as plan, month_digests
    from churnlake.session import checkpoint
    first, second, calendar = _deliveries(_dm(spark, sf_dir))
    return plan(checkpoint(month_digests(second)), checkpoint(month_digests(first)), calendar)


@job("backfill_changed")
def backfill_changed(spark, sf_dir):
    """The gold feature store after a first backfill and a change-driven one."""
    from churnlake.plans import changes
    from churnlake.schema import GOLD_FEATURE_SCHEMA
    first, second, calendar = _deliveries(_dm(spark, sf_dir))
    root = shared_path(spark, "mart")
    changes.backfill_changed(spark, first, root, calendar)
    changes.backfill_changed(spark, second, root, calendar)
    return feeds.read_store(spark, f"{root}/gold/feature_store", schema=GOLD_FEATURE_SCHEMA)


# ---- store layouts: schema versions, co-located buckets -----------------------------------------

# months before the first date were written without the payment method and with a narrower tenure, those between
# the two with the narrower tenure only
VERSION_CUTS = ("1994-01-01", "1996-01-01")


def _versioned_store(spark, sf_dir):
    """The gold feature store as three jobs wrote it over time, and the schema declared now."""
    from pyspark.sql import types as T

    from churnlake.schema import GOLD_FEATURE_SCHEMA
    gold, path, date = _dm(spark, sf_dir).gold_features, shared_path(spark, "versions"), F.col("Snapshot_Date")
    narrow = gold.withColumn("tenure", F.col("tenure").cast("smallint"))
    now = T.StructType([T.StructField("tenure", T.LongType()) if f.name == "tenure" else f for f in GOLD_FEATURE_SCHEMA.fields])
    first, second = [F.to_date(F.lit(d)) for d in VERSION_CUTS]
    feeds.write_partitioned(narrow.where(date < first).drop("PaymentMethod"), path)
    feeds.write_partitioned(narrow.where((date >= first) & (date < second)), path)
    feeds.write_partitioned(gold.withColumn("tenure", F.col("tenure").cast("bigint")).where(date >= second), path)
    return path, now


@job("evolved_store")
def evolved_store(spark, sf_dir):
    """All months under the schema of the last, with a default for the column that the first lack."""
    from churnlake.sources import evolution
    path, schema = _versioned_store(spark, sf_dir)
    return evolution.read_evolved(spark, path, schema, {"PaymentMethod": "not recorded"})


@job("schema_drift")
def schema_drift(spark, sf_dir):
    from churnlake.sources import evolution
    return evolution.schema_drift(spark, *_versioned_store(spark, sf_dir))


STORE_BUCKETS = 4


@job("colocated_analysis_set")
def colocated_analysis_set(spark, sf_dir):
    """features ⨝ meta ⨝ labels over stores bucketed on the customer."""
    from churnlake.sources import colocated
    silver, tables = _dm(spark, sf_dir).silver, {}
    for feed in ("features", "meta", "labels"):
        tables[feed] = colocated.create_store(spark, f"co_{feed}", silver[feed], STORE_BUCKETS)
        colocated.write_months(silver[feed], tables[feed], STORE_BUCKETS)
    return colocated.gold_join(spark, **tables)


@job("cleaning_funnel_features")
def cleaning_funnel_features(spark, sf_dir):
    return cleaning_funnel(_dm(spark, sf_dir).raw["features"], "features")


@job("cleaning_funnel_meta")
def cleaning_funnel_meta(spark, sf_dir):
    return cleaning_funnel(_dm(spark, sf_dir).raw["meta"], "meta")


# ---- modelling set, calendar, splits, imputation --------------------------------------

def _mset(spark, sf_dir, planted=False):
    dm = _dm(spark, sf_dir, planted)
    return stores.modelling_set(dm.gold_labels, dm.gold_features, TRAIN_DATE)


def _parts(spark, sf_dir, planted=False):
    """train / test / oot rows of the modelling set (null labels left out).

    The time-split modelling set is written once to the shared checkpoint
    folder: the split, the imputation fit and the output all read it.
    """
    from churnlake.session import checkpoint
    ts = checkpoint(stores.temporal_split(_mset(spark, sf_dir, planted), TRAIN_DATE))
    tt = stores.stratified_split(ts.where(F.col("part") == "train_test").drop("part"))
    return tt.unionByName(ts.where(F.col("part") == "oot"))


@job("null_counts")
def null_counts(spark, sf_dir):
    return quality.null_counts(_mset(spark, sf_dir))


@job("modelling_set")
def modelling_set(spark, sf_dir):
    return _mset(spark, sf_dir)


@job("train_calendar")
def train_calendar(spark, sf_dir):
    months = _dm(spark, sf_dir).gold_labels.select(F.trunc("Snapshot_Date", "month").alias("d")).distinct()
    return months.where(F.col("d").isNotNull()).select(*stores.train_calendar(F.col("d")))


@job("temporal_split")
def temporal_split(spark, sf_dir):
    return stores.temporal_split(_mset(spark, sf_dir), TRAIN_DATE).select(
        "customerID", "Snapshot_Date", "Churn", "part")


@job("stratified_split")
def stratified_split(spark, sf_dir):
    return _parts(spark, sf_dir).where(F.col("part") != "oot").select(
        "customerID", "Snapshot_Date", "Churn", "part")


@job("split_summary")
def split_summary(spark, sf_dir):
    return stores.split_summary(_parts(spark, sf_dir))


def _imputed(spark, sf_dir, cols, how):
    parts = _parts(spark, sf_dir)
    train = parts.where(F.col("part") == "train")
    out = how(parts, cols, train)
    return out.select("customerID", "Snapshot_Date", "part", *cols)


@job("median_impute")
def median_impute(spark, sf_dir):
    return _imputed(spark, sf_dir, NUMERIC_FEATURES, impute.median_impute)


@job("mode_impute")
def mode_impute(spark, sf_dir):
    return _imputed(spark, sf_dir, CATEGORICAL_FEATURES, impute.mode_impute)


@job("batch_impute")
def batch_impute(spark, sf_dir):
    """Every snapshot of the feature store with its own statistics."""
    out = impute.batch_impute(_dm(spark, sf_dir).gold_features, NUMERIC_FEATURES, CATEGORICAL_FEATURES, "Snapshot_Date")
    return out.select("customerID", "Snapshot_Date", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)


@job("constant_fill")
def constant_fill(spark, sf_dir):
    """The whole merged set, as the monitor fills it."""
    out = impute.constant_then_median_fill(_dm(spark, sf_dir).eda, CONSTANT_FILLS, NUMERIC_FEATURES)
    return out.select("customerID", "Snapshot_Date", *NUMERIC_FEATURES)


@job("tenure_groups")
def tenure_groups(spark, sf_dir):
    from churnlake.functions.scoring import tenure_group
    return _dm(spark, sf_dir).gold_features.select(
        "customerID", "Snapshot_Date", "tenure", tenure_group("tenure").alias("tenure_group"))


# ---- encoders / scalers ----------------------------------------------------------------

SCALED = ["tenure", "MonthlyCharges", "TotalCharges"]


def _train_and_all(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return parts.where(F.col("part") == "train"), parts


@job("label_encode")
def label_encode(spark, sf_dir):
    gold = _dm(spark, sf_dir).gold_features
    return feat.label_encode(gold, gold, BINARY_COLUMNS).select("customerID", "Snapshot_Date", *BINARY_COLUMNS)


@job("onehot")
def onehot(spark, sf_dir):
    train, parts = _train_and_all(spark, sf_dir)
    return feat.one_hot_slots(train, parts, CATEGORICAL_FEATURES)


@job("onehot_drop_first")
def onehot_drop_first(spark, sf_dir):
    """Drop-first dummies ``col_value`` as (customerID, Snapshot_Date, dummy, value) rows."""
    gold = _dm(spark, sf_dir).gold_features
    return feat.one_hot_drop_first_long(gold, gold, CATEGORICAL_FEATURES, ["customerID", "Snapshot_Date"])


@job("standard_scale")
def standard_scale(spark, sf_dir):
    train, parts = _train_and_all(spark, sf_dir)
    out = feat.standard_scale(train, parts, SCALED)
    return out.select("customerID", "Snapshot_Date", "part", *[F.round(c, 6).alias(c) for c in SCALED])


@job("minmax_scale")
def minmax_scale(spark, sf_dir):
    train, parts = _train_and_all(spark, sf_dir)
    out = feat.minmax_scale(train, parts, SCALED)
    return out.select("customerID", "Snapshot_Date", "part", *[F.round(c, 6).alias(c) for c in SCALED])


# ---- models (rows-only checks: fits are not SQL) ------------------------------------------


MODEL_FILE_ROWS = 25_000

# (application id, sf_dir) -> folder of the modelling rows; (application id, sf_dir, kind) -> folder of the fitted model
_MODEL_DATA: dict[tuple[str, str], str] = {}
_FITTED: dict[tuple[str, str, str], str] = {}


def _model_data(spark, sf_dir):
    """Planted-label modelling parts, imputed, written once per session for the repeated passes of the fits.

    Rebalanced, so that each of a fit's many small jobs has one task per partition worth reading and no more, in
    files of at most ``MODEL_FILE_ROWS`` rows: a file is read by one task, and a fit passes over the rows hundreds of
    times.
    """
    key = (session_key(spark), sf_dir)
    if key not in _MODEL_DATA:
        path = shared_path(spark, "model_data")
        models.prepare(_parts(spark, sf_dir, planted=True)).hint("rebalance").write.option(
            "maxRecordsPerFile", MODEL_FILE_ROWS).parquet(path)
        _MODEL_DATA[key] = path
    return feeds.read_store(spark, _MODEL_DATA[key])


def _fitted(spark, sf_dir, kind):
    """The model of a kind on the train part: fitted and saved at first use, then loaded."""
    key = (session_key(spark), sf_dir, kind)
    if key not in _FITTED:
        train = _train(_model_data(spark, sf_dir))
        estimator = models.gbt_estimator() if kind == "gbt" else models.lr_estimator(train.count(), max_iter=1000)
        path = shared_path(spark, f"model_{kind}")
        models.save(models.fit_pipeline(train, estimator), path)
        _FITTED[key] = path
    return models.load(_FITTED[key])


def _train(data):
    return data.where(F.col("part") == "train")


@job("lr_default")
def lr_default(spark, sf_dir):
    data = _model_data(spark, sf_dir)
    n = _train(data).count()
    model = models.fit_pipeline(_train(data), models.lr_estimator(n))
    return models.evaluate(model, data.where(F.col("part") == "test"), "lr_default")


@job("lr_grid_search")
def lr_grid_search(spark, sf_dir):
    """All 10 points of the search space, 5 folds."""
    train = _train(_model_data(spark, sf_dir))
    return models.search_table(spark, models.search(train, "lr", models.lr_points()))


@job("gbt_base")
def gbt_base(spark, sf_dir):
    test = _model_data(spark, sf_dir).where(F.col("part") == "test")
    return models.evaluate(_fitted(spark, sf_dir, "gbt"), test, "gbt_base")


@job("gbt_random_search")
def gbt_random_search(spark, sf_dir):
    """All ``TREE_DRAWS`` points drawn from the search space, 5 folds."""
    train = _train(_model_data(spark, sf_dir))
    return models.search_table(spark, models.search(train, "gbt", models.tree_points()))


@job("oot_evaluation")
def oot_evaluation(spark, sf_dir):
    data = _model_data(spark, sf_dir)
    lr, gbt = [models.evaluate(_fitted(spark, sf_dir, kind), data, kind) for kind in ("lr", "gbt")]
    return lr.unionByName(gbt)


@job("lr_importance")
def lr_importance(spark, sf_dir):
    return models.importance(_fitted(spark, sf_dir, "lr"), "lr")


@job("gbt_importance")
def gbt_importance(spark, sf_dir):
    return models.importance(_fitted(spark, sf_dir, "gbt"), "gbt")


@job("batch_scoring")
def batch_scoring(spark, sf_dir):
    """The saved model, loaded, scores one snapshot of the written gold store; predictions written and re-read."""
    dm = _dm(spark, sf_dir, planted=True)
    model = _fitted(spark, sf_dir, "gbt")
    store = shared_path(spark, "gold_feature_store")
    feeds.write_partitioned(dm.gold_features, store)
    cal = stores.calendar_dates(TRAIN_DATE)
    snap = feeds.read_store(spark, store).where(F.col("Snapshot_Date") == F.lit(cal["oot_start_date"]))
    train = _train(_model_data(spark, sf_dir))
    snap = impute.mode_impute(impute.median_impute(snap, NUMERIC_FEATURES, train), CATEGORICAL_FEATURES, train)
    preds = models.score(model, snap, "gbt_churn")
    out = shared_path(spark, "model_predictions")
    feeds.write_predictions(preds, out, csv_copy=out + "_csv")
    return feeds.read_predictions(spark, out, out + "_csv")


@job("model_reload")
def model_reload(spark, sf_dir):
    """Reload check over the whole test part: saved and reloaded models give the same scores."""
    data = _model_data(spark, sf_dir)
    n = _train(data).count()
    model = models.fit_pipeline(_train(data), models.lr_estimator(n, max_iter=1000))
    path = shared_path(spark, "model_lr")
    models.save(model, path)
    test = data.where(F.col("part") == "test")
    a = models.positive_probability(model.transform(test)).select(*KEYS_, F.col("churn_probability").alias("a"))
    b = models.positive_probability(models.load(path).transform(test)).select(*KEYS_, F.col("churn_probability").alias("b"))
    return a.join(b, KEYS_).agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"))


KEYS_ = ["customerID", "Snapshot_Date"]


# ---- factorize / correlation ------------------------------------------------------------------

# Column order of the merged analysis set: features, then meta, then the label.
EDA_COLUMNS = RAW_FEATURE_COLUMNS + ["gender", "SeniorCitizen", "Partner", "Dependents", "Churn"]
EDA_ORDER = ["Snapshot_Date", "customerID"]


def _eda_keyed(spark, sf_dir):
    eda = _dm(spark, sf_dir).eda
    return eda.select(*EDA_COLUMNS, F.col("Snapshot_Date").alias("_k_date"), F.col("customerID").alias("_k_id"))


@job("factorize_codes")
def factorize_codes(spark, sf_dir):
    codes = explore.factorize_codes(_eda_keyed(spark, sf_dir), EDA_COLUMNS, ["_k_date", "_k_id"])
    return codes.select(F.col("_k_id").alias("customerID"), F.col("_k_date").alias("Snapshot_Date"),
                        "column_name", "code")


@job("correlation_lower")
def correlation_lower(spark, sf_dir):
    return explore.correlation_lower(_eda_keyed(spark, sf_dir), EDA_COLUMNS, ["_k_date", "_k_id"])


# ---- exports ----------------------------------------------------------------------------------

@job("merged_analysis_set")
def merged_analysis_set(spark, sf_dir):
    """The merged features ⨝ meta ⨝ labels set exported as CSV by the executors and read back typed."""
    eda = _dm(spark, sf_dir).eda
    path = shared_path(spark, "telco_merged")
    eda.write.mode("overwrite").option("header", True).csv(path)
    return feeds.read_csv_typed(spark, path, eda.schema)


@job("label_map")
def label_map(spark, sf_dir):
    from churnlake.functions.scoring import label_map as _label_map
    raw = _dm(spark, sf_dir).raw["labels"]
    return raw.select("customerID", "Snapshot_Date", _label_map("Churn").alias("Churn"))


# ---- streaming --------------------------------------------------------------------------------

def _bronze_stream(spark, sf_dir, feed):
    """Incremental bronze ingest (Structured Streaming, availableNow) of one feed's raw drops."""
    from churnlake.plans.datasets import raw_drops
    from churnlake.streaming.ingest import ingest_available
    root = raw_drops(spark, sf_dir)
    out, ckpt = shared_path(spark, "bronze_stream"), shared_path(spark, "bronze_stream_ckpt")
    ingest_available(spark, f"{root}/{feed}", feed, out, ckpt)
    return feeds.read_bronze(spark, out, feed)


for _feed in ["features", "meta", "labels"]:
    REGISTRY[f"bronze_stream_{_feed}"] = lambda spark, sf_dir, feed=_feed: _bronze_stream(spark, sf_dir, feed)


@job("bronze_stream_redelivery")
def bronze_stream_redelivery(spark, sf_dir):
    """Label drops ingested by the stream; the second drop delivers the first month of each quarter again, with
    half of its customers and other labels, and so replaces these months."""
    from churnlake.streaming.ingest import ingest_drops, read_drops
    raw, root = _dm(spark, sf_dir).raw["labels"], shared_path(spark, "label_drops")
    out, ckpt = shared_path(spark, "bronze_drops"), shared_path(spark, "bronze_drops_ckpt")
    feeds.write_raw_csv(raw, f"{root}/drop-0001")
    ingest_drops(spark, root, "labels", out, ckpt)
    again = raw.where(F.substring("Snapshot_Date", 6, 2).isin("01", "04", "07", "10") & (F.substring("customerID", 2, 12).cast("int") % 2 == 0))
    feeds.write_raw_csv(again.withColumn("Churn", F.when(F.col("Churn") == "Yes", "No").otherwise("Yes")), f"{root}/drop-0002")
    ingest_drops(spark, root, "labels", out, ckpt, max_files_per_trigger=1)
    return read_drops(spark, "labels", out)
