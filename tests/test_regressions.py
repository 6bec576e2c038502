"""Results that were wrong away from the fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlake.operators import monitor
from churnlake.operators.ranking import exact_quantiles
from churnlake.schema import SILVER_SCHEMAS
from churnlake.session import shared_path
from churnlake.sources import feeds

from conftest import SF_SMALL

JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


@pytest.mark.parametrize("feed", ["features", "meta", "labels"])
def test_stream_rows_equal_batch_rows(spark, feed):
    from oracle_queries import ORACLE  # noqa: F401 - the statements of both jobs are one
    from churnlake.plans.registry import REGISTRY

    streamed, batch = (REGISTRY[f"{job}_{feed}"](spark, SF_SMALL) for job in ("bronze_stream", "bronze_snapshot"))
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0 and streamed.count() == batch.count()


def test_fanout_counts_pairs_of_other_snapshots(spark):
    df = lambda rows: spark.createDataFrame(rows, "customerID string, Snapshot_Date date")
    got = monitor.customer_only_fanout(df([("a", JAN), ("b", JAN), ("b", JAN), ("x", JAN), ("n", None)]),
                                       df([("a", FEB), ("b", JAN), ("b", FEB), ("y", JAN), ("n", None)])).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {"a": (1, 1, 1, 1), "b": (2, 2, 4, 2), "n": (1, 1, 1, 1)}


def test_marks_use_unrounded_values(spark):
    months = spark.createDataFrame([(0.7999996,)], "auc double")
    assert monitor.auc_summary(months).first().passes is False
    assert monitor.psi_status(F.lit(0.1)) is not None
    row = spark.range(1).select(monitor.psi_status(F.lit(0.1000004)).alias("s")).first()
    assert row.s == "warning"


def test_predictions_fall_back_to_the_written_copy_only_without_parquet(spark):
    root = shared_path(spark, "predictions")
    df = spark.createDataFrame([("a", 0.5, "m", "2024-01-01")], "customerID string, churn_probability double, model_name string, snapshot_date string")
    df.write.option("header", True).csv(f"{root}_csv")
    assert feeds.read_predictions(spark, root, f"{root}_csv").count() == 1
    spark.createDataFrame([("broken",)], "value string").write.text(f"{root}/part")
    assert feeds.read_predictions(spark, root, f"{root}_csv").count() == 1
    df.write.parquet(f"{root}2")
    assert feeds.read_predictions(spark, f"{root}2").first().customerID == "a"


def test_store_without_rows_reads_as_empty(spark):
    path = shared_path(spark, "empty_store")
    feeds.write_partitioned(spark.createDataFrame([], SILVER_SCHEMAS["labels"]), path)
    assert feeds.read_store(spark, path, schema=SILVER_SCHEMAS["labels"]).count() == 0


def test_quantiles_do_not_shuffle_the_histogram_by_group(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("x"))
    got = exact_quantiles(df, "x", [0.5], ["g"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {r.g: r.value for r in got.collect()} == {0: 2499.0, 1: 2500.0, 2: 2499.5}
