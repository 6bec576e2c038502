"""End-to-end jobs on sf0.001: raw CSV -> bronze -> silver -> gold -> train -> score -> monitor."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from churnlake.plans import models, pipelines
from churnlake.plans.datasets import Datamart
from churnlake.session import shared_path
from churnlake.sources import feeds


@pytest.fixture(scope="module")
def raw_csv(spark):
    """The fixture feeds written once as raw CSV drops (as the source receives them)."""
    dm = Datamart(spark, SF_SMALL, planted=True)
    root = shared_path(spark, "raw")
    for feed, df in dm.raw.items():
        df.write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
            .option("ignoreTrailingWhiteSpace", False).csv(f"{root}/{feed}")
    return root, dm


def test_backfill_train_score_monitor(spark, raw_csv):
    root_raw, dm = raw_csv
    raw = {f: feeds.read_raw_csv(spark, f"{root_raw}/{f}", f).select(dm.raw[f].columns) for f in pipelines.FEEDS}
    root = shared_path(spark, "mart")
    months = ["1998-04-01", "1998-05-01", "1998-06-01", "1998-07-01"]
    counts = pipelines.backfill(spark, raw, root, months)
    assert counts["silver/labels"] == counts["bronze/labels"] > 0
    gold = spark.read.parquet(f"{root}/gold/feature_store")
    assert gold.count() == counts["gold/feature_store"]
    assert dm.gold_features.where(F.col("Snapshot_Date").isin(
        [F.to_date(F.lit(m)) for m in months])).count() == counts["gold/feature_store"]
    # re-running one month is idempotent and leaves the others alone
    again = pipelines.backfill(spark, raw, root, months[:1])
    assert spark.read.parquet(f"{root}/gold/feature_store").count() == counts["gold/feature_store"]
    assert again["gold/label_store"] < counts["gold/label_store"]

    model_root = shared_path(spark, "models")
    ev = pipelines.train(spark, root, "1998-08-01", model_root, kind="gbt", draws=1, folds=2,
                         tree_grid={**models.TREE_GRID, "n_estimators": [5]})
    assert {r.part for r in ev.collect()} == {"train", "test", "oot"}
    preds = pipelines.score(spark, root, f"{model_root}/gbt/1998-08-01", "1998-07-01", "gbt_churn")
    n_snap = gold.where(F.col("Snapshot_Date") == F.to_date(F.lit("1998-07-01"))).count()
    assert preds.count() == n_snap
    # logistic regression path, scored with the batch's own statistics
    ev_lr = pipelines.train(spark, root, "1998-08-01", model_root, kind="lr", folds=2, c_values=[1.0],
                            penalties=["l2"])
    assert {r.part for r in ev_lr.collect()} == {"train", "test", "oot"}
    lr_preds = pipelines.score(spark, root, f"{model_root}/lr/1998-08-01", "1998-07-01", "lr_churn", stats_from="batch")
    assert lr_preds.count() == n_snap
    paths = pipelines.run_monitoring(spark, root, model_name="gbt_churn")
    assert spark.read.parquet(paths["monthly_auc"]).count() == 1
    paths = pipelines.run_monitoring(spark, root)
    assert spark.read.parquet(paths["monthly_auc"]).count() == len(months)


def test_streaming_bronze_matches_batch(spark, raw_csv):
    from churnlake.streaming.ingest import ingest_available
    root_raw, dm = raw_csv
    out = shared_path(spark, "bronze_stream")
    ckpt = shared_path(spark, "bronze_stream_ckpt")
    ingest_available(spark, f"{root_raw}/labels", "labels", out, ckpt)
    streamed = feeds.read_bronze(spark, out, "labels")
    assert streamed.count() == feeds.bronze(dm.raw["labels"]).count()
    ingest_available(spark, f"{root_raw}/labels", "labels", out, ckpt)  # nothing new: no duplicates
    assert feeds.read_bronze(spark, out, "labels").count() == streamed.count()
