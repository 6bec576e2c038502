"""Exact ordered running sums, ranks and quantiles without one task per group.

A plain ``Window.partitionBy(g).orderBy(x)`` puts every row of a group into a
single task; with a handful of huge groups (two labels, a few months, one
column) that is a straggler at scale.  Here the rows are range-partitioned on
(group, order) instead, so a group may span many tasks:

1. ``repartitionByRange(n, group, order)`` (sampled bounds, works for any key
   type); the range partition id is stored as ``_pid`` and the frame is
   checkpointed to the shared checkpoint folder so ids are pinned.
2. running sum inside each (_pid, group) slice – bounded by the partition size;
3. per (_pid, group) totals – at most partitions + groups rows – give each
   slice its offset with a window over that small table; joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.session import checkpoint, stored


TOTALS_BYTES = 64 << 20


def running_sums(df: DataFrame, group_cols: list[str], order_cols: list[str],
                 value_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """Add ``cum_<v>``: inclusive running sum of each value column within the group,
    in ``order_cols`` order.  Rows should be unique on group_cols + order_cols
    (aggregate to a histogram first); equal keys are summed in arbitrary order.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    ranged = df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id())
    ranged = checkpoint(ranged)
    w_local = (Window.partitionBy("_pid", *group_cols).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(v).over(w_local).alias(f"_loc_{v}") for v in value_cols])
    totals = ranged.groupBy("_pid", *group_cols).agg(*[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    w_before = (Window.partitionBy(*group_cols).orderBy("_pid")
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        F.col("_pid").alias("_opid"), *[F.col(g).alias(f"_og_{g}") for g in group_cols],
        *[F.coalesce(F.sum(f"_tot_{v}").over(w_before), F.lit(0)).alias(f"_off_{v}") for v in value_cols],
    )
    cond = local["_pid"] == offsets["_opid"]
    for g in group_cols:
        cond = cond & local[g].eqNullSafe(offsets[f"_og_{g}"])
    # offsets has at most (partitions + groups) rows: a bounded broadcast.
    joined = local.join(F.broadcast(offsets), cond, "inner")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_off_{v}") + F.col(f"_loc_{v}")).alias(f"cum_{v}") for v in value_cols],
    )


def exact_rank(df: DataFrame, group_cols: list[str], order_cols: list[str],
               rank_col: str = "rank") -> DataFrame:
    """1-based row number within the group in ``order_cols`` order (keys must be unique)."""
    ranked = running_sums(df.withColumn("_one", F.lit(1).cast("bigint")), group_cols, order_cols, ["_one"])
    return ranked.withColumnRenamed("cum__one", rank_col).drop("_one")


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float],
                    group_cols: list[str] | None = None, weight_col: str | None = None) -> DataFrame:
    """Linear-interpolated percentiles (numpy default) of ``value_col`` per group, nulls ignored.

    Output: group_cols + (q_idx int, prob double, value double).  Works from the
    value histogram, so memory per task is bounded by the partition size.
    ``weight_col`` treats each input row as that many copies of its value
    (pass a histogram directly).
    """
    keep = list(group_cols or [])
    group_cols = keep or ["_q_all"]
    if not keep:
        df = df.withColumn("_q_all", F.lit(0))
    v = F.col(value_col).cast("double")
    weight = F.col(weight_col).cast("bigint") if weight_col else F.lit(1).cast("bigint")
    # written: the range bounds, the running sums and the totals read it, and ``df`` may be a join of large tables
    hist = stored(df.where(v.isNotNull()).groupBy(*group_cols, v.alias("_x"))
                  .agg(F.sum(weight).alias("_n")), "value_histogram")
    cum = running_sums(hist, group_cols, ["_x"], ["_n"])
    totals = hist.groupBy(*group_cols).agg(F.sum("_n").alias("_total"))
    # one row per group; a shuffle join on the group would bring a group's histogram into one task
    totals = checkpoint(totals)
    few = totals.count() * 256 <= TOTALS_BYTES
    cum = cum.join(F.broadcast(totals) if few else totals, group_cols, "inner")     # many groups: none is large
    pos = [F.lit(p) * (F.col("_total") - 1) for p in probs]
    targets = F.array(*[
        F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("p"), F.lit(side).alias("side"),
                 (F.floor(pos[i]) if side == 0 else F.ceil(pos[i])).cast("bigint").alias("idx"),
                 (pos[i] - F.floor(pos[i])).alias("frac"))
        for i, p in enumerate(probs) for side in (0, 1)
    ])
    hits = cum.select(
        *group_cols, "_x",
        F.explode(F.filter(targets, lambda t: (t["idx"] >= F.col("cum__n") - F.col("_n"))
                           & (t["idx"] < F.col("cum__n")))).alias("t"),
    )
    out = hits.groupBy(*group_cols, F.col("t.qi").alias("q_idx"), F.col("t.p").alias("prob")).agg(
        F.max(F.when(F.col("t.side") == 0, F.col("_x"))).alias("_lo"),
        F.max(F.when(F.col("t.side") == 1, F.col("_x"))).alias("_hi"),
        F.max("t.frac").alias("_frac"),
    )
    return out.select(
        *keep, F.col("q_idx").cast("int").alias("q_idx"), "prob",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("value"),
    )
