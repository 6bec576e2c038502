"""Property tests over the fixture chain: joins, splits, imputation, sinks, models."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from churnlake.operators import impute, stores
from churnlake.plans.datasets import Datamart
from churnlake.plans.registry import REGISTRY, _parts
from churnlake.session import shared_path
from churnlake.sources import feeds


@pytest.fixture(scope="module")
def dm(spark):
    return Datamart(spark, SF_SMALL)


def test_entry_runs(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    df = entry(spark)
    assert df.columns == ["Snapshot_Date", "churn_0", "churn_1"]
    assert df.count() > 0
    missing = set(oracle_sql()) - set(queries())
    assert not missing


def test_gold_join_keys_once(dm):
    gold = dm.gold_features
    assert gold.columns[:2] == ["customerID", "Snapshot_Date"]
    assert len(gold.columns) == 21
    assert gold.count() == gold.select("customerID", "Snapshot_Date").distinct().count()


def test_split_disjoint_exhaustive_stratified(spark):
    parts = _parts(spark, SF_SMALL)
    tt = parts.where(F.col("part") != "oot")
    assert tt.count() == tt.select("customerID", "Snapshot_Date").distinct().count()
    counts = {(r.Churn, r.part): r["count"] for r in tt.groupBy("Churn", "part").count().collect()}
    for label in (0, 1):
        n = counts.get((label, "train"), 0) + counts.get((label, "test"), 0)
        assert counts.get((label, "train"), 0) == int(n * 0.8)


def test_split_hash_option_same_proportions(spark, dm):
    mset = stores.modelling_set(dm.gold_labels, dm.gold_features, "1998-08-01")
    approx = stores.stratified_split(mset.where("Churn IS NOT NULL"), exact=False)
    share = approx.where("part = 'train'").count() / approx.count()
    assert 0.6 < share < 0.95


def test_median_and_mode_fit_on_train_only(spark):
    df = spark.createDataFrame([(1.0, "a", "train"), (3.0, "a", "train"), (None, None, "test"), (100.0, "b", "test")],
                               "x double, c string, part string")
    train = df.where("part = 'train'")
    got = impute.mode_impute(impute.median_impute(df, ["x"], train), ["c"], train).collect()
    filled = [r for r in got if r.part == "test" and r.c == "a"][0]
    assert filled.x == 2.0
    allnull = spark.createDataFrame([(None,), (None,)], "c string")
    assert impute.fit_modes(allnull, ["c"]) == {"c": "Unknown"}
    tie = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "c string")
    assert impute.fit_modes(tie, ["c"]) == {"c": "a"}


def test_dynamic_overwrite_is_idempotent_and_scoped(spark):
    df = spark.createDataFrame([("A", 1, "1998-04-01"), ("B", 2, "1998-05-01")], "k string, v int, Snapshot_Date string")
    path = shared_path(spark, "overwrite_test")
    feeds.write_partitioned(df, path)
    feeds.write_partitioned(df.where("Snapshot_Date = '1998-05-01'").withColumn("v", F.lit(9)), path)
    feeds.write_partitioned(df.where("Snapshot_Date = '1998-05-01'").withColumn("v", F.lit(9)), path)
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {"A": 1, "B": 9}


def test_required_columns_guard(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(feeds.MissingColumns):
        feeds.bronze(df)
    with pytest.raises(ValueError):
        feeds.validate_nonempty(df.where("a = 'y'"), ["a"], "frame")


def test_customer_only_fanout_is_product(dm):
    from churnlake.operators.monitor import customer_only_fanout
    f = dm.silver["features"]
    lab = dm.gold_labels
    out = customer_only_fanout(f, lab)
    total = out.agg(F.sum("joined_rows")).first()[0]
    assert total == f.join(lab, "customerID").count()


def test_unseen_category_does_not_raise_in_pipeline(spark):
    from churnlake.plans.features import one_hot_slots
    train = spark.createDataFrame([("C1", "1998-04-01", "a"), ("C2", "1998-04-01", "b")],
                                  "customerID string, Snapshot_Date string, c string")
    test = spark.createDataFrame([("C3", "1998-05-01", "z"), ("C4", "1998-05-01", None)],
                                 "customerID string, Snapshot_Date string, c string")
    got = one_hot_slots(train, test, ["c"]).collect()
    assert all(r.slot is None and r.width == 2 for r in got)


@pytest.mark.slow
def test_model_learns_planted_signal_and_reloads(spark):
    from churnlake.plans import models
    data = models.prepare(_parts(spark, "/root/testdata/sf0.01", planted=True)).cache()
    train = data.where("part = 'train'")
    model = models.fit_pipeline(train, models.gbt_estimator(max_iter=10))
    ev = {r.part: r.auc for r in models.evaluate(model, data, "gbt").collect()}
    assert ev["test"] > 0.5  # ~70% of label rows have no feature row (imputed), diluting the signal
    path = shared_path(spark, "model_test")
    models.save(model, path)
    a = models.positive_probability(model.transform(train)).agg(F.sum("churn_probability")).first()[0]
    b = models.positive_probability(models.load(path).transform(train)).agg(F.sum("churn_probability")).first()[0]
    assert a == pytest.approx(b, rel=1e-12)


def test_nonempty_files_and_prediction_fallback(spark):
    import os
    root = shared_path(spark, "listing")
    df = spark.createDataFrame([("C1", "m", 1, 0.9, "1998-04-01")],
                               "customerID string, model_name string, model_predictions int, "
                               "churn_probability double, snapshot_date string")
    df.write.parquet(f"{root}/p")
    local = root.removeprefix("file:")
    open(os.path.join(local, "p", "empty.parquet"), "w").close()
    files = feeds.nonempty_files(spark, f"{root}/p")
    assert files and not any(f.endswith("empty.parquet") for f in files)
    df.write.option("header", True).csv(f"{root}/csv_only")
    back = feeds.read_predictions(spark, f"{root}/csv_only")
    assert back.count() == 1 and "churn_probability" in back.columns


def test_drop_first_dummies_and_unseen_raises(spark):
    from churnlake.plans.features import one_hot_drop_first, one_hot_drop_first_long
    train = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("k3", "c")], "k string, c string")
    wide = one_hot_drop_first(train, train, ["c"]).orderBy("k").collect()
    assert [(r["c_b"], r["c_c"]) for r in wide] == [(0, 0), (1, 0), (0, 1)]
    assert one_hot_drop_first_long(train, train, ["c"], ["k"]).count() == 6
    unseen = spark.createDataFrame([("k9", "z")], "k string, c string")
    with pytest.raises(Exception, match="unseen category"):
        one_hot_drop_first(train, unseen, ["c"]).collect()


def test_factorize_broadcast_and_shuffle_paths_agree(spark):
    from churnlake.operators.explore import factorize_codes
    df = spark.createDataFrame([(i % 7, f"id{i:03d}", ["a", "b", None][i % 3]) for i in range(60)],
                               "d int, k string, c string")
    a = factorize_codes(df, ["c", "k"], ["d", "k"]).collect()
    b = factorize_codes(df, ["c", "k"], ["d", "k"], broadcast_max=0).collect()
    assert sorted(a) == sorted(b)
    first = {r.c: r for r in df.orderBy("d", "k").collect()[::-1]}  # last write wins -> first appearance
    codes = {(r.k, r.column_name): r.code for r in a}
    order = [v for v in dict.fromkeys(r.c for r in df.orderBy("d", "k").collect()) if v is not None]
    for v, row in first.items():
        assert codes[(row.k, "c")] == (-1 if v is None else order.index(v))
