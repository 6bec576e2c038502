"""Imputation: exact medians and modes fitted on one part and applied to all.

Statistics are computed distributed (histograms + range-partitioned running
sums for medians, partial-aggregated value counts for modes); only the
bounded result – one value per column (per batch) – is used downstream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.operators.ranking import exact_quantiles


def _long(df: DataFrame, cols: list[str], cast: str, group_cols: list[str]) -> DataFrame:
    stack = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in cols)
    return df.selectExpr(*[f"`{g}`" for g in group_cols], f"stack({len(cols)}, {stack}) AS (column_name, value)")


def medians(df: DataFrame, cols: list[str], group_cols: list[str] | None = None) -> DataFrame:
    """Exact median (pandas/numpy linear) per column (and group): group_cols + (column_name, median)."""
    group_cols = list(group_cols or [])
    q = exact_quantiles(_long(df, cols, "DOUBLE", group_cols), "value", [0.5], [*group_cols, "column_name"])
    return q.select(*group_cols, "column_name", F.col("value").alias("median"))


def modes(df: DataFrame, cols: list[str], group_cols: list[str] | None = None,
          default: str = "Unknown") -> DataFrame:
    """Most frequent non-null value per column (ties -> smallest), all-null -> ``default``."""
    group_cols = list(group_cols or [])
    long = _long(df, cols, "STRING", group_cols)
    counts = long.where(F.col("value").isNotNull()).groupBy(*group_cols, "column_name", "value").agg(
        F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*group_cols, "column_name").agg(
        F.min(F.struct((-F.col("_n")).alias("neg"), F.col("value").alias("v"))).alias("_b"))
    present = long.select(*group_cols, "column_name").distinct()
    return present.join(best, [*group_cols, "column_name"], "left").select(
        *group_cols, "column_name", F.coalesce(F.col("_b.v"), F.lit(default)).alias("mode"))


def fill_values(df: DataFrame, values: dict[str, object], cast: str | None = None) -> DataFrame:
    """coalesce(column, value) for the listed columns; others unchanged."""
    cols = []
    for c in df.columns:
        if c in values:
            v = F.lit(values[c])
            col: Column = F.coalesce(F.col(c).cast(cast) if cast else F.col(c), v)
            cols.append(col.alias(c))
        else:
            cols.append(F.col(c))
    return df.select(cols)


def fit_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Bounded result: one median per column, brought to the driver."""
    return {r.column_name: r.median for r in medians(df, cols).collect()}


def fit_modes(df: DataFrame, cols: list[str]) -> dict[str, str]:
    return {r.column_name: r.mode for r in modes(df, cols).collect()}


def median_impute(df: DataFrame, cols: list[str], fit_on: DataFrame) -> DataFrame:
    """Fill nulls of numeric ``cols`` with medians fitted on ``fit_on`` (result columns are double)."""
    stats = {k: v for k, v in fit_medians(fit_on, cols).items() if v is not None}
    out = df.select([F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    return fill_values(out, stats)


def mode_impute(df: DataFrame, cols: list[str], fit_on: DataFrame) -> DataFrame:
    return fill_values(df, fit_modes(fit_on, cols))


def batch_impute(df: DataFrame, numeric: list[str], categorical: list[str], batch_col: str) -> DataFrame:
    """Impute each batch (e.g. scoring snapshot) with its own medians and modes.

    The per-batch statistics (batches x columns rows) are pivoted to one row per
    batch and joined back on the batch key.
    """
    med = medians(df, numeric, [batch_col]).groupBy(batch_col).pivot("column_name", numeric).agg(
        F.first("median"))
    mod = modes(df, categorical, [batch_col]).groupBy(batch_col).pivot("column_name", categorical).agg(
        F.first("mode"))
    med = med.select(batch_col, *[F.col(c).alias(f"_m_{c}") for c in numeric])
    mod = mod.select(batch_col, *[F.col(c).alias(f"_o_{c}") for c in categorical])
    joined = df.join(med, batch_col, "left").join(mod, batch_col, "left")
    cols = []
    for c in df.columns:
        if c in numeric:
            cols.append(F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")).alias(c))
        elif c in categorical:
            cols.append(F.coalesce(F.col(c), F.col(f"_o_{c}")).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(cols)


def constant_then_median_fill(df: DataFrame, constants: dict[str, float], numeric: list[str]) -> DataFrame:
    """Constants for the listed columns, then the column median for other numerics, then 0."""
    filled = fill_values(df, constants, cast="double")
    rest = [c for c in numeric if c not in constants]
    stats = fit_medians(filled, rest) if rest else {}
    cols = []
    for c in filled.columns:
        if c in rest:
            med = stats.get(c)
            cols.append(F.coalesce(F.col(c).cast("double"), F.lit(med if med is not None else 0.0)).alias(c))
        else:
            cols.append(F.col(c))
    return filled.select(cols)
