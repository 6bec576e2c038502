"""Monitoring from stored, mergeable per-month state: a new month reads only itself.

State of a month is either its value histogram (feature, value, rows, positive
labels), exact, or one KLL sketch per feature, of bounded size whatever the
month's rows.  Both are written as one partition per month, so a month that is
computed again replaces its own state only, and reports read the state of the
months they cover, never the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.scoring import month_label
from churnlake.operators.monitor import (
    MONITOR_FEATURES, auc_of_histogram, long_features, month_alerts, psi_from_histogram, psi_status)
from churnlake.schema import PSI_DECILES, PSI_ZERO_SHARE
from churnlake.sources.feeds import write_partitioned

HISTOGRAM_SCHEMA = "feature string, value double, rows long, positives long, month_start date"
SKETCH_SCHEMA = "feature string, sketch binary, rows long, month_start date"
SKETCH_K = 4000
# an upper bound of the rank error of one sketch of that size, both sides (about 2.446 / k**0.9433)
SKETCH_ERROR = 2.446 / SKETCH_K ** 0.9433


def histograms(mon: DataFrame, features: list[str] | None = None) -> DataFrame:
    """(feature, value, rows, positives, month_start) of the given monitoring rows."""
    features = features or MONITOR_FEATURES
    stack = ", ".join(f"'{f}', CAST({f} AS DOUBLE)" for f in features)
    long = mon.selectExpr("month_start", "CAST(actual_churn AS INT) AS y", f"stack({len(features)}, {stack}) AS (feature, value)")
    return long.where(F.col("value").isNotNull()).groupBy("feature", "value", "month_start").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.coalesce(F.col("y"), F.lit(0))).cast("long").alias("positives")).select(
        "feature", "value", "rows", "positives", "month_start")


def sketches(mon: DataFrame, features: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """(feature, sketch, rows, month_start): one KLL sketch per feature and month."""
    long = long_features(mon, features).where(F.col("value").isNotNull())
    return long.groupBy("feature", "month_start").agg(
        F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("rows")).select(
        "feature", "sketch", "rows", "month_start")


def update_state(state: DataFrame, path: str) -> None:
    """Store the state of the months in ``state``; each replaces what was stored for it."""
    write_partitioned(state, path, partition_by="month_start")


def read_state(spark: SparkSession, path: str, schema: str = HISTOGRAM_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def psi_from_state(state: DataFrame, baseline_month: str | None = None) -> DataFrame:
    """The PSI report from stored histograms; equal to a recomputation from all rows."""
    hist = state.select("feature", "month_start", "value", F.col("rows").alias("_c"))
    baseline = None if baseline_month is None else F.col("month_start") == F.to_date(F.lit(baseline_month))
    table = psi_from_histogram(hist, baseline).where("after_baseline")
    return table.select("feature", "month_start", month_label("month_start").alias("month"),
                        F.round("psi", 6).alias("psi"), psi_status(F.col("psi")).alias("status"))


def auc_from_state(state: DataFrame, score: str = "churn_probability") -> DataFrame:
    """Monthly AUC, label counts and alerts from the stored histograms of the score (rows without a label must
    have been left out of the state, as the monitoring set does)."""
    hist = state.where(F.col("feature") == score).select(
        "month_start", F.col("value").alias("_s"), F.col("positives").alias("_pos"), (F.col("rows") - F.col("positives")).alias("_neg"))
    return month_alerts(auc_of_histogram(hist, ["month_start"], digits=None))


def psi_from_sketches(state: DataFrame, baseline_month: str | None = None) -> DataFrame:
    """(feature, month_start, psi): PSI against the baseline month (default: the earliest) from sketches alone.

    Edges are the baseline sketch's deciles (at most nine per feature, brought to the driver); a month's share of
    a bin is the difference of its sketch's ranks of the two edges.  Every share is off by at most twice
    ``SKETCH_ERROR`` of its month, whatever the number of rows.
    """
    baseline = F.to_date(F.lit(baseline_month)) if baseline_month else state.agg(F.min("month_start")).scalar()
    cuts = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(d / 100)) for d in PSI_DECILES[1:-1]])
    edges = state.where(F.col("month_start") == baseline).select("feature", F.array_sort(F.array_distinct(cuts)).alias("edges")).collect()
    parts = []
    for r in edges:         # one row per monitored feature
        ranks = [F.lit(0.0), *[F.kll_sketch_get_rank_double("sketch", F.lit(e)) for e in r["edges"]], F.lit(1.0)]
        shares = F.array(*[high - low for low, high in zip(ranks, ranks[1:])])
        parts.append(state.where(F.col("feature") == r["feature"]).select("feature", "month_start", shares.alias("shares"),
                                                                         (F.col("month_start") == baseline).alias("is_base"),
                                                                         (F.col("month_start") > baseline).alias("after")))
    if not parts:
        return state.select("feature", "month_start", F.lit(0.0).alias("psi")).limit(0)
    shares = reduce(DataFrame.unionByName, parts)
    base = shares.where("is_base").select(F.col("feature").alias("b_feature"), F.col("shares").alias("b_shares"))
    terms = F.transform(F.arrays_zip("shares", "b_shares"), lambda z: (_nonzero(z["shares"]) - _nonzero(z["b_shares"])) * F.log(
        _nonzero(z["shares"]) / _nonzero(z["b_shares"])))
    joined = shares.where("after").join(F.broadcast(base), F.col("feature") == F.col("b_feature"))      # one row per feature
    return joined.select("feature", "month_start", F.aggregate(terms, F.lit(0.0), lambda a, t: a + t).alias("psi"))


def _nonzero(share: Column) -> Column:
    return F.when(share <= 0, F.lit(PSI_ZERO_SHARE)).otherwise(share)
