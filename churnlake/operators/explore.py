"""Exploratory aggregates over the merged analysis set (features ⨝ meta ⨝ labels).

All are single group-bys with map-side partial aggregation, so a hot value
(one category holding a third of the rows) is pre-combined in every task
before the shuffle.  Shares over a whole result are taken on the already
aggregated rows (a handful of groups), never on raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.scoring import eda_tenure_bin
from churnlake.operators.ranking import TOTALS_BYTES, exact_rank
from churnlake.session import checkpoint


def churn_distribution(df: DataFrame, label_col: str = "Churn") -> DataFrame:
    """Count per label value (nulls excluded) and its percent of all rows."""
    counts = df.groupBy(F.col(label_col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()  # scalar subquery over the few aggregated rows
    return counts.select(
        F.col("_v").alias(label_col),
        F.col("_n").cast("bigint").alias("n"),
        F.round(F.col("_n") * 100.0 / total, 6).alias("pct"),
    ).where(F.col(label_col).isNotNull())


def crosstab(df: DataFrame, dimension: str, label_col: str = "Churn") -> DataFrame:
    """Counts per (dimension value, label value); nulls on either side excluded."""
    return (
        df.where(F.col(dimension).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(dimension).cast("string").alias("value"), F.col(label_col))
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        .select(F.lit(dimension).alias("dimension"), "value", label_col, "n")
    )


def normalised_rate(df: DataFrame, by: str, label_col: str = "Churn",
                    label_values: tuple = (0, 1), fill: float | None = None) -> DataFrame:
    """Share of each label value within each ``by`` group (label nulls ignored), pivoted.

    A label value absent from a group gives null (``fill`` replaces it).
    """
    lab = F.col(label_col)
    aggs = [F.count(lab).alias("_n")]
    aggs += [F.count_if(lab == v).alias(f"_c{i}") for i, v in enumerate(label_values)]
    grouped = df.groupBy(by).agg(*aggs).where(F.col("_n") > 0)
    cols = []
    for i, v in enumerate(label_values):
        share = F.col(f"_c{i}") / F.col("_n")
        share = F.when(F.col(f"_c{i}") > 0, share)
        if fill is not None:
            share = F.coalesce(share, F.lit(float(fill)))
        cols.append(F.round(share, 6).alias(f"{label_col.lower()}_{v}"))
    return grouped.select(by, *cols)


def rate_by_gender(df: DataFrame) -> DataFrame:
    return normalised_rate(df, "gender")


def monthly_rate(df: DataFrame) -> DataFrame:
    """Per snapshot month: share of each label value, missing -> 0, sorted by date."""
    return normalised_rate(df, "Snapshot_Date", fill=0.0).orderBy("Snapshot_Date")


def tenure_bin_churn(df: DataFrame, label_col: str = "Churn") -> DataFrame:
    """Counts per exploration tenure bin and label (tenure outside (0,73] dropped)."""
    return (
        df.select(eda_tenure_bin("tenure").alias("tenure_bin"), F.col(label_col))
        .where(F.col("tenure_bin").isNotNull() & F.col(label_col).isNotNull())
        .groupBy("tenure_bin", label_col)
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    )


def snapshot_dates(df: DataFrame) -> DataFrame:
    """Distinct snapshot dates, ordered."""
    return df.select("Snapshot_Date").distinct().orderBy("Snapshot_Date")


# ---- factorize + correlation ------------------------------------------------------

def appearance_codes(df: DataFrame, columns: list[str], order_cols: list[str]) -> DataFrame:
    """(column_name, value, code) of every non-null value: code = order of first appearance in its column, 0-based.

    "First appearance" needs an explicit row order: ``order_cols`` (unique per
    row).  Distinct values per column are ranked by their first row with the
    range-partitioned rank, so a high-cardinality column (customer ids) never
    lands in one task.
    """
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    long = df.selectExpr(*[f"`{c}`" for c in order_cols],
                         f"stack({len(columns)}, {stack}) AS (column_name, value)")
    firsts = (long.where(F.col("value").isNotNull())
              .groupBy("column_name", "value")
              .agg(F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)])).alias("_f")))
    firsts = firsts.select("column_name", "value", *[F.col(f"_f._o{i}").alias(f"_o{i}") for i in range(len(order_cols))])
    ranked = exact_rank(firsts, ["column_name"], [f"_o{i}" for i in range(len(order_cols))], "_rank")
    return checkpoint(ranked.select("column_name", "value", (F.col("_rank") - 1).cast("int").alias("code")))


def _small_columns(codes: DataFrame, columns: list[str], broadcast_max: int) -> list[str]:
    """The columns, smallest first, whose codes fit into ``broadcast_max`` bytes together (measured)."""
    # bytes of a column's codes, with 128 a row for the hash table's overhead: one small row per column
    sizes = {r.column_name: r.n for r in codes.groupBy("column_name").agg(
        F.sum(F.octet_length("column_name") + F.octet_length("value") + 128).alias("n")).collect()}
    small, held = [], 0
    for c in sorted(columns, key=lambda c: sizes.get(c, 0)):
        held += sizes.get(c, 0)
        if held <= broadcast_max:
            small.append(c)
    return small


def factorize_codes(df: DataFrame, columns: list[str], order_cols: list[str],
                    broadcast_max: int = TOTALS_BYTES) -> DataFrame:
    """Per column, code = order of first appearance of the value (0-based), null -> -1.

    Long form (order_cols..., column_name, code).

    Joining the codes back: the smallest columns' codes that fit into
    ``broadcast_max`` bytes together (measured first) are broadcast – a hot value
    (one category holding a third of all rows) then never meets a shuffle.  The
    other columns take the shuffle join, where AQE splits any skewed partition.
    Both give the same rows.
    """
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    long = df.selectExpr(*[f"`{c}`" for c in order_cols],
                         f"stack({len(columns)}, {stack}) AS (column_name, value)")
    codes = appearance_codes(df, columns, order_cols)
    small = _small_columns(codes, columns, broadcast_max)
    large = [c for c in columns if c not in small]
    parts = []
    if small:
        small_codes = codes.where(F.col("column_name").isin(small))
        parts.append(long.where(F.col("column_name").isin(small))
                     .join(F.broadcast(small_codes), ["column_name", "value"], "left"))
    if large:
        parts.append(long.where(F.col("column_name").isin(large))
                     .join(codes.where(F.col("column_name").isin(large)), ["column_name", "value"], "left"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(*order_cols, "column_name", F.coalesce(F.col("code"), F.lit(-1)).alias("code"))


NULL_SALTS = 1024   # a column's null rows are spread over this many keys in a shuffle join


def code_columns(df: DataFrame, columns: list[str], order_cols: list[str],
                 broadcast_max: int = TOTALS_BYTES) -> DataFrame:
    """One row per row of ``df``: the codes of ``columns`` (as ``factorize_codes`` gives them) as int columns of
    these names, looked up column by column without an unpivot.

    Dictionaries that fit into ``broadcast_max`` bytes together are broadcast; a larger one takes a shuffle join
    on its value, with the null rows, which match nothing, spread over ``NULL_SALTS`` keys.
    """
    codes = appearance_codes(df, columns, order_cols)
    small = _small_columns(codes, columns, broadcast_max)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in order_cols]), F.lit(NULL_SALTS)).cast("int")
    out = df.select(salt.alias("_salt"), *[F.col(f"`{c}`").cast("string").alias(f"_v{i}") for i, c in enumerate(columns)])
    # the large ones first, while the rows still carry no codes
    for i, c in sorted(enumerate(columns), key=lambda ic: ic[1] in small):
        of_column = codes.where(F.col("column_name") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"_c{i}"))
        if c in small:
            out = out.join(F.broadcast(of_column), F.col(f"_v{i}") == F.col("_value"), "left")
        else:
            key = F.when(F.col(f"_v{i}").isNull(), F.col("_salt")).otherwise(F.lit(-1))
            out = out.withColumn("_key", key).join(of_column.withColumn("_at", F.lit(-1)),
                                                   (F.col(f"_v{i}") == F.col("_value")) & (F.col("_key") == F.col("_at")),
                                                   "left").drop("_key", "_at")
        out = out.drop("_value", f"_v{i}")
    return out.select(*[F.coalesce(F.col(f"_c{i}"), F.lit(-1)).alias(c) for i, c in enumerate(columns)])


def correlation_lower(df: DataFrame, columns: list[str], order_cols: list[str],
                      broadcast_max: int = TOTALS_BYTES) -> DataFrame:
    """Pearson correlation of the columns' codes, lower triangle only: (row, col, corr).

    The rows stay wide: codes are attached column by column and the co-moments of all pairs come from one
    aggregation with a partial one per task.  A constant column has no correlation (null).
    """
    wide = code_columns(df, columns, order_cols, broadcast_max)
    pairs = [(i, j) for i in range(len(columns)) for j in range(i)]
    code = [F.col(f"`{c}`").cast("double") for c in columns]
    aggs = [F.try_divide(F.covar_pop(code[i], code[j]), F.stddev_pop(code[i]) * F.stddev_pop(code[j])).alias(f"p{i}_{j}")
            for i, j in pairs]
    res = wide.agg(*aggs)
    stack = ", ".join(f"'{columns[i]}', '{columns[j]}', p{i}_{j}" for i, j in pairs)
    return res.selectExpr(f"stack({len(pairs)}, {stack}) AS (row, col, corr)").select(
        "row", "col", F.round("corr", 6).alias("corr"))
