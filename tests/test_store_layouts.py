"""Schema versions of a store, bucketed stores that join without an exchange, codes looked up column by column."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.operators.explore import code_columns, correlation_lower, factorize_codes
from churnlake.session import shared_path
from churnlake.sources import colocated, evolution, feeds

JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))
NOW = T.StructType([T.StructField("customerID", T.StringType()), T.StructField("n", T.LongType()),
                    T.StructField("plan", T.StringType()), T.StructField("Snapshot_Date", T.DateType())])


def versions(spark):
    path = shared_path(spark, "evolve")
    for rows, schema in [([("a", 1, JAN), ("b", None, JAN)], "customerID string, n int, Snapshot_Date date"),
                         ([("a", 2, None, FEB), ("b", 3, "x", FEB)], "customerID string, n int, plan string, Snapshot_Date date"),
                         ([("a", 1 << 40, "y", 7, MAR)], "customerID string, n bigint, plan string, old int, Snapshot_Date date")]:
        feeds.write_partitioned(spark.createDataFrame(rows, schema), path)
    return path


def test_versions_read_as_one(spark):
    path = versions(spark)
    got = evolution.read_evolved(spark, path, NOW, {"plan": "it's \\ new"})
    assert got.columns == NOW.names and [f.dataType for f in got.schema.fields] == [f.dataType for f in NOW.fields]
    # missing column: default; stored null: null
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("a", 1, "it's \\ new", JAN), ("b", None, "it's \\ new", JAN), ("a", 2, None, FEB), ("b", 3, "x", FEB),
        ("a", 1 << 40, "y", MAR)], key=str)
    assert evolution.read_evolved(spark, path, NOW).where("plan IS NULL").count() == 3
    # filters on a defaulted column agree with its values, also where they are pushed down
    plan = {"plan": "p"}
    assert evolution.read_evolved(spark, path, NOW, plan).where("plan = 'p'").count() == 2
    assert evolution.read_evolved(spark, path, NOW, plan).where("plan IS NULL").count() == 1
    assert evolution.read_evolved(spark, path, NOW, plan).where(F.col("n") > (1 << 35)).count() == 1
    with pytest.raises(ValueError, match="lacks"):
        evolution.read_evolved(spark, path, NOW, {"nope": 1})


def test_drift_and_incompatible(spark):
    path = versions(spark)
    got = sorted(map(tuple, evolution.schema_drift(spark, path, NOW).collect()), key=str)
    assert got == [(JAN, "n", "int", "bigint", "widened"), (JAN, "plan", None, "string", "added"),
                   (FEB, "n", "int", "bigint", "widened"), (MAR, "old", "int", None, "extra")]
    narrow = T.StructType([T.StructField("n", T.IntegerType()) if f.name == "n" else f for f in NOW.fields])
    with pytest.raises(evolution.IncompatibleSchema, match="2024-03-01 n: bigint stored, int declared"):
        evolution.read_evolved(spark, path, narrow)
    empty = shared_path(spark, "evolve_empty")
    spark.createDataFrame([], NOW).write.parquet(empty)
    assert evolution.schema_drift(spark, empty, NOW).count() == 0 and evolution.read_evolved(spark, empty, NOW).count() == 0


@pytest.mark.parametrize("stored,declared,state", [
    ("int", "int", "same"), (None, "int", "added"), ("int", None, "extra"), ("smallint", "int", "widened"),
    ("bigint", "int", "incompatible"), ("decimal(10,2)", "decimal(12,2)", "widened"),
    ("decimal(10,2)", "decimal(12,5)", "incompatible"), ("string", "int", "incompatible"), ("float", "double", "widened")])
def test_column_state(stored, declared, state):
    assert evolution.column_state(stored, declared) == state


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_colocated_join_needs_no_exchange(spark):
    rows = [(f"c{i}", i, m) for i in range(200) for m in (JAN, FEB)]
    tables = {}
    for name, keep in [("features", lambda i: True), ("meta", lambda i: i % 2 == 0), ("labels", lambda i: i % 3 == 0)]:
        df = spark.createDataFrame([r for r in rows if keep(r[1])], f"customerID string, {name}_v int, Snapshot_Date date")
        tables[name] = colocated.create_store(spark, name, df, 4)
        colocated.write_months(df, tables[name], 4)
    old = {k: spark.conf.get(k, None) for k in colocated.COLOCATED_CONF}
    try:
        for k, v in colocated.COLOCATED_CONF.items():
            spark.conf.set(k, v)
        joined = colocated.gold_join(spark, **tables)
        plan = plan_of(joined)
        assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 2, plan
        assert sorted(joined.collect()) == sorted(
            [(f"c{i}", m, i, i, i) for _, i, m in rows if i % 6 == 0])
        # one month read: directories are pruned and still no exchange
        one = colocated.gold_join(spark, **tables).where(F.col("Snapshot_Date") == FEB)
        assert "Exchange" not in plan_of(one) and one.count() == 34
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # a month written again replaces that month alone; the layout's files are one a bucket
    again = spark.createDataFrame([("c0", 99, FEB)], "customerID string, meta_v int, Snapshot_Date date")
    colocated.write_months(again, tables["meta"], 4)
    meta = spark.table(tables["meta"])
    assert meta.where(F.col("Snapshot_Date") == FEB).collect() == again.select(meta.columns).collect()
    assert meta.where(F.col("Snapshot_Date") == JAN).count() == 100
    files = spark.table(tables["features"]).groupBy("Snapshot_Date").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert {r.n for r in files.collect()} <= {1, 2, 3, 4}
    for t in tables.values():
        colocated.drop_store(spark, t)
    with pytest.raises(ValueError):
        colocated.create_store(spark, "none", again, 0)


@pytest.mark.parametrize("broadcast_max", [64 << 20, 0, 5000])
def test_code_columns_agree_with_long_form(spark, broadcast_max):
    rng = np.random.default_rng(5)
    values = [None, "x", "y", "z", ""]
    rows = [(i, values[rng.integers(5)], None if rng.random() < 0.7 else float(rng.integers(40)), f"id{i % 90}", None) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, a string, b double, c string, d string")
    cols = ["a", "b", "c", "d"]
    long = {(r.k, r.column_name): r.code for r in factorize_codes(df, cols, ["k"]).collect()}
    wide = code_columns(df.withColumn("key", F.col("k").cast("string")), [*cols, "key"], ["k"], broadcast_max).collect()
    assert len(wide) == 300     # the key's code is its row's number
    assert {(r.key, c): r[c] for r in wide for c in cols} == long
    matrix = np.array([[long[(k, c)] for c in cols] for k in range(300)], float)
    got = {(r.row, r.col): r["corr"] for r in correlation_lower(df, cols, ["k"], broadcast_max).collect()}
    assert len(got) == 6 and all(got[("d", c)] is None for c in "abc")
    for (x, y), v in got.items():
        if x != "d":
            assert v == pytest.approx(np.corrcoef(matrix[:, cols.index(x)], matrix[:, cols.index(y)])[0, 1], abs=1e-6)


def test_correlation_keeps_rows_wide(spark):
    df = spark.createDataFrame([(i, str(i % 3), str(i % 5)) for i in range(50)], "k int, a string, b string")
    plan = correlation_lower(df, ["a", "b"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in plan and "pivot" not in plan
