"""Jobs on large tables: inputs read once, files and join parts of bounded size."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from churnlake.operators import monitor
from churnlake.operators.ranking import exact_quantiles
from churnlake.plans import datasets, registry
from churnlake.sources import feeds, fixtures


@pytest.fixture
def sf(spark, tmp_path):
    spark.sql("""SELECT id AS o_orderkey, id % 40 AS o_custkey, CAST(id * 37 % 30000 AS DOUBLE) AS o_totalprice,
                 TIMESTAMP '1998-04-03' + make_dt_interval(CAST(id * 11 % 150 AS INT)) AS o_orderdate FROM range(400)""") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def counted(spark, rows, schema):
    """Rows as a DataFrame, and how many of them jobs have read."""
    reads = spark.sparkContext.accumulator(0)

    def read(row):
        reads.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(read), schema), reads


def data_files(path):
    return [f for _, _, found in os.walk(path.removeprefix("file:")) for f in found if f.startswith("part-")]


def test_orders_are_grouped_once_for_all_drops(spark, sf, monkeypatch):
    calls = []
    monkeypatch.setattr(datasets, "FILE_ROWS", 50)
    monkeypatch.setattr(datasets, "order_months", lambda *a: calls.append(a) or fixtures.order_months(*a), raising=False)
    for planted in (False, True):
        root = datasets.raw_drops(spark, sf, planted)
        for feed, df in fixtures.raw_feeds(spark, sf, planted).items():
            got = feeds.read_raw_csv(spark, f"{root}/{feed}", feed)
            assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
            assert len(data_files(f"{root}/{feed}")) >= df.count() / 50
    assert len(calls) == 1


def test_quantiles_read_their_input_once(spark):
    df, reads = counted(spark, [(i % 3, float(i % 17)) for i in range(300)], "g int, v double")
    got = exact_quantiles(df, "v", [0.5], ["g"]).collect()
    assert {r["g"]: r["value"] for r in got} == {0: 8.0, 1: 8.0, 2: 8.0}
    assert reads.value == 300


@pytest.mark.parametrize("curve", [monitor.kde_table, monitor.kde_binned])
def test_kde_reads_its_input_once(spark, curve):
    rows = [("f", dt.date(2024, 4, 1), float(i * i % 97)) for i in range(300)]
    df, reads = counted(spark, rows, "feature string, month_start date, value double")
    assert sorted(r["point"] for r in curve(df, grid_size=25).collect()) == list(range(25))
    assert reads.value == 300


def test_kde_table_gives_every_point_for_any_grid_size(spark):
    from math import exp, pi, sqrt
    values = [1.0, 2.0, 2.0, 4.0, 7.5]
    long = spark.createDataFrame([("f", dt.date(2024, 4, 1), v) for v in values], "feature string, month_start date, value double")
    mean = sum(values) / 5
    bw = sqrt(sum((v - mean) ** 2 for v in values) / 4) * 5 ** -0.2
    for size in (7, 20, 23):
        got = sorted((r["point"], r["x"], r["density"]) for r in monitor.kde_table(long, grid_size=size).collect())
        assert [g[0] for g in got] == list(range(size))
        for _, x, density in got:
            assert density == pytest.approx(sum(exp(-0.5 * ((x - v) / bw) ** 2) for v in values) / (5 * bw * sqrt(2 * pi)), abs=2e-6)


def test_truth_join_is_dealt_by_rows(spark, monkeypatch):
    day = dt.date(2024, 4, 1)
    ids = [(f"c{i}", day) for i in range(60)]
    preds = spark.createDataFrame([(*k, "m", 1, 0.5) for k in ids], "customerID string, snapshot_date date, model_name string, "
                                  "model_predictions int, churn_probability double")
    feats = spark.createDataFrame([(*k, 20.0) for k in ids], "customerID string, Snapshot_Date date, MonthlyCharges double")
    labels = spark.createDataFrame([(*k, i % 2 if i % 3 else None) for i, k in enumerate(ids)], "customerID string, Snapshot_Date date, Churn int")
    monkeypatch.setattr(monitor, "JOIN_ROWS", 5, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = monitor.pred_truth_join(preds, feats, labels)
        assert got.count() == 40
        assert got.rdd.getNumPartitions() == 12
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_model_rows_lie_in_files_of_bounded_size(spark, sf, monkeypatch):
    monkeypatch.setattr(registry, "MODEL_FILE_ROWS", 5, raising=False)
    rows = registry._model_data(spark, sf)
    sizes = [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) > 20 and max(sizes) <= 5


def test_label_store_is_not_shuffled_again(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(datasets, "write_partitioned", lambda df, path, **o: seen.append(o))
    df = spark.range(1).select("id", F.lit("2024-04-01").alias("Snapshot_Date"))
    for name in ("gold_label_store", "gold_feature_store"):
        datasets.written(spark, name, df)
    assert seen == [{"rebalance": False}, {"rebalance": True}]
