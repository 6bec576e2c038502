"""Readiness and data-quality reports (no job per check; one plan per report)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.cleaning import text_to_date


def _snapshot(df: DataFrame) -> F.Column:
    return text_to_date("Snapshot_Date") if dict(df.dtypes)["Snapshot_Date"] == "string" else F.col("Snapshot_Date")


def snapshot_row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows per (layer, feed, snapshot_date) over every table given."""
    parts = [
        df.groupBy(_snapshot(df).alias("snapshot_date")).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
        .select(F.lit(layer).alias("layer"), F.lit(feed).alias("feed"), "snapshot_date", "rows")
        for (layer, feed), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def readiness_gaps(tables: dict[tuple[str, str], DataFrame], calendar: DataFrame) -> DataFrame:
    """Expected (layer, feed, month) with no rows: one row per gap.

    expected = calendar x (layer, feed) built by exploding a literal list (no
    join), then ``left_anti`` against the months present in each table.
    """
    names = F.array(*[F.struct(F.lit(l).alias("layer"), F.lit(f).alias("feed")) for l, f in tables])
    expected = calendar.select("snapshot_date", F.explode(names).alias("t")).select(
        "t.layer", "t.feed", "snapshot_date")
    present = reduce(DataFrame.unionByName, [
        df.select(F.lit(layer).alias("layer"), F.lit(feed).alias("feed"),
                  F.trunc(_snapshot(df), "month").alias("snapshot_date")).distinct()
        for (layer, feed), df in tables.items()
    ])
    return expected.join(present, ["layer", "feed", "snapshot_date"], "left_anti")


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column in one aggregation: (column_name, nulls)."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, nulls)").select(
        "column_name", F.col("nulls").cast("bigint"))


def layer_funnel(raw: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """Rows that each layer loses, per snapshot date: one row per date, and one with a null date for raw rows
    whose date does not parse (which bronze leaves out).

    ``<feed>_raw`` = ``<feed>_date_lost`` + ``<feed>_rules_lost`` + ``<feed>_silver``.  The joins of the gold layer
    are accounted for by one co-count of key flags, without building them: ``gold_rows``, the silver rows without a
    partner (``features_without_meta``, ``meta_without_features``), gold rows without a label row and label rows
    without a gold row.  All sums are partial aggregates; keys meet once.
    """
    names = list(raw)
    counted = reduce(DataFrame.unionByName, [
        df.select(_snapshot(df).alias("snapshot_date"), F.lit(f).alias("feed"), F.lit(1).alias("r"), F.lit(0).alias("s"))
        for f, df in raw.items()] + [
        df.select(F.col("Snapshot_Date").alias("snapshot_date"), F.lit(f).alias("feed"), F.lit(0).alias("r"), F.lit(1).alias("s"))
        for f, df in silver.items()])
    per_feed = counted.groupBy("snapshot_date").agg(*[
        F.sum(F.when(F.col("feed") == f, F.col(c)).otherwise(0)).alias(f"{f}_{c}") for f in names for c in ("r", "s")])
    flags = reduce(DataFrame.unionByName, [
        df.select("customerID", F.col("Snapshot_Date").alias("snapshot_date"),
                  *[F.lit(int(f == g)).alias(f"_{g}") for g in names]) for f, df in silver.items()])
    keys = flags.groupBy("customerID", "snapshot_date").agg(*[F.sum(f"_{f}").alias(f) for f in names])
    real = F.col("customerID").isNotNull() & F.col("snapshot_date").isNotNull()
    gold = F.when(real, F.col("features") * F.col("meta")).otherwise(0)
    joins = keys.groupBy("snapshot_date").agg(
        F.sum(F.when(~real | (F.col("meta") == 0), F.col("features")).otherwise(0)).alias("features_without_meta"),
        F.sum(F.when(~real | (F.col("features") == 0), F.col("meta")).otherwise(0)).alias("meta_without_features"),
        F.sum(gold).alias("gold_rows"),
        F.sum(F.when(F.col("labels") == 0, gold).otherwise(0)).alias("gold_without_label"),
        F.sum(F.when(gold == 0, F.col("labels")).otherwise(0)).alias("labels_without_gold"))
    both = per_feed.withColumnRenamed("snapshot_date", "_d").join(joins, F.col("_d").eqNullSafe(F.col("snapshot_date")), "left")
    lost = F.col("_d").isNull()
    out = [F.col("_d").alias("snapshot_date")]
    for f in names:
        r, s = F.col(f"{f}_r"), F.col(f"{f}_s")
        out += [r.alias(f"{f}_raw"), F.when(lost, r - s).otherwise(0).alias(f"{f}_date_lost"),
                F.when(lost, F.lit(0)).otherwise(r - s).alias(f"{f}_rules_lost"), s.alias(f"{f}_silver")]
    more = ["features_without_meta", "meta_without_features", "gold_rows", "gold_without_label", "labels_without_gold"]
    out += [F.coalesce(c, F.lit(0)).alias(c) for c in more]
    shown = both.select(*out)
    return shown.select("snapshot_date", *[F.col(c).cast("bigint").alias(c) for c in shown.columns[1:]])


def preview(tables: dict[tuple[str, str], DataFrame], rows: int = 5) -> DataFrame:
    """The first ``rows`` rows of every (layer, feed, snapshot date) by customerID (null last), ties by the row's
    MD5: (layer, feed, snapshot_date, place, customerID, row_md5).

    Each task keeps its own first rows of a group before the shuffle, so a group sends at most that many rows a
    task, whatever its size.
    """
    parts = []
    for (layer, feed), df in tables.items():
        text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
        parts.append(df.select(F.lit(layer).alias("layer"), F.lit(feed).alias("feed"), _snapshot(df).alias("snapshot_date"),
                               "customerID", F.md5(text).alias("row_md5")))
    order = Window.partitionBy("layer", "feed", "snapshot_date").orderBy(F.col("customerID").asc_nulls_last(), "row_md5")
    return (reduce(DataFrame.unionByName, parts).withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows)
            .select("layer", "feed", "snapshot_date", "place", "customerID", "row_md5"))
