"""Change-driven backfill, drops delivered again, stored monitoring state, binned curves, selection without ranks."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.operators import monitor, monitor_state, quality, stores
from churnlake.plans import changes, pipelines
from churnlake.schema import GOLD_FEATURE_SCHEMA, RAW_SCHEMAS, SILVER_SCHEMAS
from churnlake.session import checkpoint, shared_path
from churnlake.sources import feeds
from churnlake.streaming import ingest

JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


def labels(spark, rows):
    return spark.createDataFrame([(c, y, d) for c, y, d in rows], RAW_SCHEMAS["labels"])


def test_digest_ignores_order_and_counts_repeats(spark):
    rows = [("a", "Yes", "2024-01-01"), ("b", None, "2024-01-01"), ("b", "", "2024-02-01"), ("c", "No", "bad date")]
    get = lambda rows: {r["snapshot_date"]: (r["rows"], r["digest"]) for r in changes.month_digests({"labels": labels(spark, rows)}).collect()}
    one = get(rows)
    assert set(one) == {JAN, FEB} and get(rows[::-1]) == one
    assert get([*rows, rows[0]])[JAN] != one[JAN] and get([*rows, rows[0]])[FEB] == one[FEB]
    assert get([rows[0], ("b", "-", "2024-01-01"), *rows[2:]])[JAN] != one[JAN]       # null is no value
    assert get([("a", None, "2024-01-01"), ("b", "Yes", "2024-01-01"), *rows[2:]])[JAN] != one[JAN]


def test_plan_states(spark):
    frame = lambda rows: spark.createDataFrame(rows, "feed string, snapshot_date date, rows long, digest string")
    was = frame([("features", JAN, 2, "x"), ("meta", JAN, 2, "y"), ("labels", JAN, 2, "z"), ("meta", FEB, 1, "m")])
    now = frame([("features", JAN, 2, "x"), ("meta", JAN, 2, "other"), ("labels", JAN, 2, "z"), ("features", FEB, 1, "f")])
    cal = spark.createDataFrame([(JAN,), (FEB,)], "snapshot_date date")
    got = {(r["layer"], r["feed"], r["snapshot_date"].month): (r["action"], r["reason"]) for r in changes.backfill_plan(now, was, cal).collect()}
    assert got[("bronze", "features", 1)] == ("skip", "unchanged") and got[("silver", "meta", 1)] == ("rebuild", "changed")
    assert got[("gold", "feature_store", 1)] == ("rebuild", "meta changed") and got[("gold", "label_store", 1)] == ("skip", "unchanged")
    assert got[("bronze", "meta", 2)] == ("keep", "removed") and got[("bronze", "labels", 2)] == ("wait", "missing")
    assert got[("gold", "feature_store", 2)] == ("keep", "features new, meta removed")
    assert got[("gold", "label_store", 2)] == ("wait", "labels missing")


def feature(c, d, tenure="5"):
    return (c, tenure, "Yes", "No", "DSL", "No", "No", "No", "No", "No", "No", "One year", "Yes", "Mailed check", "20.5", "100", d)


def test_only_changed_months_are_written(spark):
    cal = spark.createDataFrame([(JAN,), (FEB,)], "snapshot_date date")
    days = ["2024-01-01", "2024-02-01"]

    def raw(tenure):
        return {"features": spark.createDataFrame([feature("a", days[0]), feature("a", days[1], tenure)], RAW_SCHEMAS["features"]),
                "meta": spark.createDataFrame([("a", "male", "0", "Yes", "No", d) for d in days], RAW_SCHEMAS["meta"]),
                "labels": labels(spark, [("a", "Yes", d) for d in days])}

    root = shared_path(spark, "changed")
    assert {r["action"] for r in changes.backfill_changed(spark, raw("5"), root, cal).collect()} == {"rebuild"}
    store = lambda: spark.read.schema(GOLD_FEATURE_SCHEMA).parquet(f"{root}/gold/feature_store")
    files = lambda: {r[0] for r in store().select(F.col("_metadata.file_path")).distinct().collect()}
    before = files()
    assert {r["action"] for r in changes.backfill_changed(spark, raw("5"), root, cal).collect()} == {"skip"} and files() == before
    again = {(r["layer"], r["feed"], r["snapshot_date"]) for r in changes.backfill_changed(spark, raw("6"), root, cal).where("action = 'rebuild'").collect()}
    assert again == {(x, y, FEB) for x, y in (("bronze", "features"), ("silver", "features"), ("gold", "feature_store"))}
    kept = files() & before
    assert len(kept) == 1 and "2024-01-01" in kept.pop()
    assert {r["Snapshot_Date"]: r["tenure"] for r in store().collect()} == {JAN: 5, FEB: 6}


def test_missing_upstream_stops_a_backfill(spark):
    raw = {"features": spark.createDataFrame([feature("a", "2024-01-01")], RAW_SCHEMAS["features"]),
           "meta": spark.createDataFrame([], RAW_SCHEMAS["meta"]), "labels": labels(spark, [("a", "Yes", "2024-01-01")])}
    with pytest.raises(pipelines.MissingUpstream) as e:
        pipelines.backfill(spark, raw, shared_path(spark, "mart"), ["2024-01-01"], on_missing="raise")
    assert e.value.gaps == [("meta", "2024-01-01")]


def test_drops_delivered_again_and_batches_run_again(spark):
    root, out, ckpt = (shared_path(spark, n) for n in ("drops", "out", "ckpt"))
    day = "2024-01-01"
    feeds.write_raw_csv(labels(spark, [(f"c{i}", "Yes", day) for i in range(9)] + [("x", "No", "2024-02-01")]).repartition(3), f"{root}/d1")
    ingest.ingest_drops(spark, root, "labels", out, ckpt, max_files_per_trigger=1)
    read = lambda: sorted((r["customerID"], r["Churn"], r["Snapshot_Date"]) for r in ingest.read_drops(spark, "labels", out).collect())
    assert len(read()) == 10                            # one month over several micro-batches
    again = labels(spark, [("c1", "", day), ("c2", None, day)])
    feeds.write_raw_csv(again, f"{root}/d2")
    ingest.ingest_drops(spark, root, "labels", out, ckpt)
    want = [("c1", "", day), ("c2", None, day), ("x", "No", "2024-02-01")]
    assert read() == want
    batch = again.withColumn("drop", F.lit("d2"))
    for _ in range(2):                                  # a batch id that is run again replaces what it wrote
        ingest.store_batch(batch, 77, "labels", out)
    assert len(read()) == 5
    ingest.store_batch(labels(spark, [("old", "No", day)]).withColumn("drop", F.lit("d0")), 78, "labels", out)
    assert len(read()) == 5                             # an older drop that comes late replaces nothing


@pytest.fixture(scope="module")
def mon(spark):
    rng = random.Random(8)
    rows = [(f"c{i}", m, round(rng.betavariate(2 + m.month, 5), 4), int(rng.random() < 0.3), rng.gauss(60 + 3 * m.month, 20))
            for i in range(4000) for m in [rng.choice([JAN, FEB, MAR])]]
    return checkpoint(spark.createDataFrame(rows, "customerID string, month_start date, churn_probability double, actual_churn int, monthly_charges double"))


def test_state_equals_recomputation(spark, mon):
    path = shared_path(spark, "state")
    for months in ([JAN, FEB], [MAR], [FEB]):
        monitor_state.update_state(monitor_state.histograms(mon.where(F.col("month_start").isin(months))), path)
    state = monitor_state.read_state(spark, path)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(monitor_state.psi_from_state(state)) == key(monitor.psi_report(mon))
    assert key(monitor_state.auc_from_state(state)) == key(monitor.monthly_auc(mon))


def test_sketches_stay_inside_their_bound(spark, mon):
    k = 400
    state = checkpoint(monitor_state.sketches(mon, k=k))
    got = {(r["feature"], r["month_start"]): r["psi"] for r in monitor_state.psi_from_sketches(state).collect()}
    want = {(r["feature"], r["month_start"]): r["psi"] for r in monitor.psi_report(mon).collect()}
    assert set(got) == set(want)
    # d psi = sum of d share * (log ratio + 1 - e/a) over ten bins with shares near a tenth
    bound = 10 * 4 * 2.446 / k ** 0.9433 * 2
    assert all(abs(got[x] - want[x]) < bound for x in want), (got, want)


def test_binned_curves_stay_inside_their_bound(spark, mon):
    long = checkpoint(monitor.long_features(mon, ["monthly_charges", "churn_probability"]))
    exact = {(r["feature"], r["month_start"], r["point"]): r for r in monitor.kde_table(long).collect()}
    rows = monitor.kde_binned(long, resolution=16).collect()
    assert len(rows) == len(exact) == 2 * 3 * 200
    for f, m in {(r["feature"], r["month_start"]) for r in rows}:
        v = np.array([r["value"] for r in long.where((F.col("feature") == f) & (F.col("month_start") == m)).collect()])
        bw = v.std(ddof=1) * len(v) ** -0.2
        bound = (1 / 16 ** 2 / 8 + np.exp(-32)) / (bw * np.sqrt(2 * np.pi)) + 2e-6
        mine = [r for r in rows if (r["feature"], r["month_start"]) == (f, m)]
        assert max(abs(r["density"] - exact[(f, m, r["point"])]["density"]) for r in mine) <= bound
        assert all(r["x"] == pytest.approx(exact[(f, m, r["point"])]["x"], abs=2e-6) for r in mine)


def test_selection_needs_no_shuffle_and_equals_ranks(spark):
    rows = [(f"c{i}", JAN, None if i % 50 == 0 else i % 3, "wide") for i in range(700)]
    df = checkpoint(spark.createDataFrame(rows, "customerID string, Snapshot_Date date, Churn int, more string"))
    split = stores.stratified_split(df)
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
    got = {(r["customerID"], r["part"]) for r in split.collect()}
    hashed = df.withColumn("h", stores.split_hash()).where("Churn IS NOT NULL").collect()
    want = set()
    for y in range(3):
        mine = sorted((r for r in hashed if r["Churn"] == y), key=lambda r: (r["h"], r["customerID"]))
        want |= {(r["customerID"], "train" if i < int(len(mine) * 0.8) else "test") for i, r in enumerate(mine)}
    assert got == want
    # repeated keys across a threshold: as many train rows as without
    again = stores.stratified_split(df.where("Churn = 1").limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("k")).drop("k"))
    assert again.where("part = 'train'").count() == 8


def test_layer_funnel_adds_up(spark):
    raw = {"features": spark.createDataFrame([feature(c, d) for c, d in (("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "soon"))]
                                             + [feature("d", "2024-01-01", "-4")], RAW_SCHEMAS["features"]),
           "meta": spark.createDataFrame([("a", "male", "0", "Yes", "No", "2024-01-01"), ("z", "female", "1", "No", "No", "2024-01-01")], RAW_SCHEMAS["meta"]),
           "labels": labels(spark, [("b", "Yes", "2024-01-01")])}
    silver = {f: changes.CLEANERS[f](feeds.bronze(df)) for f, df in raw.items()}
    got = {r["snapshot_date"]: r.asDict() for r in quality.layer_funnel(raw, silver).collect()}
    for r in got.values():
        for f in raw:
            assert r[f"{f}_raw"] == r[f"{f}_date_lost"] + r[f"{f}_rules_lost"] + r[f"{f}_silver"]
    assert got[None]["features_date_lost"] == 1 and got[JAN]["features_rules_lost"] == 1
    assert [got[JAN][c] for c in ("features_without_meta", "meta_without_features", "gold_rows", "gold_without_label", "labels_without_gold")] == [1, 1, 1, 1, 1]


def test_preview_keeps_few_rows_a_task(spark):
    df = spark.range(1000).select(F.concat(F.lit("c"), F.col("id") % 7).alias("customerID"), F.lit(JAN).alias("Snapshot_Date"), "id")
    out = quality.preview({("raw", "x"): df, ("gold", "y"): df.where("id < 2")}, 3)
    assert out._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2
    rows = out.collect()
    assert [r["customerID"] for r in sorted((r for r in rows if r["feed"] == "x"), key=lambda r: r["place"])] == ["c0"] * 3 and len(rows) == 5


def test_empty_gold_stores_read_as_empty(spark):
    root = shared_path(spark, "empty")
    feeds.write_partitioned(spark.createDataFrame([], GOLD_FEATURE_SCHEMA), f"{root}/gold/feature_store")
    feeds.write_partitioned(spark.createDataFrame([], SILVER_SCHEMAS["labels"]), f"{root}/gold/label_store")
    assert [df.count() for df in pipelines.gold_tables(spark, root)] == [0, 0]
