"""Raw customer feeds derived from the driver's ``orders`` table (no random numbers).

Grain: one row per (o_custkey, month of o_orderdate).  Every value is a
deterministic function of the group keys and two aggregates, so the same rows
come out of any engine.  The derivation is one partial-aggregated shuffle on
(o_custkey, month); the three feeds are narrow projections of that result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.schema import RAW_FEATURE_COLUMNS, RAW_LABEL_COLUMNS, RAW_META_COLUMNS

# --- fixed values: dirty-value recipe of the fixture feeds (index, column, values) ---
DIRTY_COLUMNS = [
    (1, "PhoneService", ["Yes", "No", "yes"]),
    (2, "MultipleLines", ["Yes", "No", "No phone service"]),
    (3, "InternetService", ["DSL", "Fiber optic", "No"]),
    (4, "OnlineSecurity", ["Yes", "No", "No internet service", "YES"]),
    (5, "OnlineBackup", ["Yes", "No", "No internet service", "YES"]),
    (6, "DeviceProtection", ["Yes", "No", "No internet service", "YES"]),
    (7, "TechSupport", ["Yes", "No", "No internet service", "YES"]),
    (8, "StreamingTV", ["Yes", "No", "No internet service", "YES"]),
    (9, "StreamingMovies", ["Yes", "No", "No internet service", "YES"]),
    (10, "Contract", ["Month-to-month", "One year", "Two year"]),
    (11, "PaperlessBilling", ["Yes", "No"]),
    (12, "PaymentMethod", ["Electronic check", "Mailed check", "Credit card (automatic)"]),
    (13, "gender", ["Male", "Female", "male"]),
    (14, "Partner", ["Yes", "No"]),
    (15, "Dependents", ["Yes", "No", "no"]),
]
DIRTY_SENTINELS = [None, "Unknown", "Not Specified"]  # (k + 7i) % 60 == 0, 1, 2
CHURN_YES_PERCENT = 27
PLANTED_YES_PERCENT = 5
PLANTED_TENURE_BELOW = 24
# --- end of fixed values ---


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cust, sd, k, p): one row per customer and order month."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return (
        orders.groupBy(
            F.col("o_custkey").alias("cust"),
            F.trunc(F.col("o_orderdate").cast("date"), "month").alias("sd"),
        )
        .agg(
            F.min("o_orderkey").alias("k"),
            F.round(F.max("o_totalprice")).cast("bigint").alias("p"),
        )
    )


def _dirty(i: int, values: list[str]) -> Column:
    k, cust = F.col("k"), F.col("cust")
    marker = (k + 7 * i) % 60
    pick = F.element_at(F.array(*[F.lit(v) for v in values]), ((k * (i + 3) + cust) % len(values) + 1).cast("int"))
    expr = None
    for pos, sentinel in enumerate(DIRTY_SENTINELS):
        val = F.lit(sentinel).cast("string")
        expr = F.when(marker == pos, val) if expr is None else expr.when(marker == pos, val)
    return expr.otherwise(pick)


def _raw_columns() -> dict[str, Column]:
    k, cust, p = F.col("k"), F.col("cust"), F.col("p")
    cols: dict[str, Column] = {
        "customerID": F.concat(F.lit("C"), cust.cast("string")),
        "Snapshot_Date": F.col("sd").cast("string"),
        "tenure": F.when(k % 97 == 0, F.lit("n/a"))
        .when(k % 89 == 0, F.lit(None).cast("string"))
        .otherwise((k % 76).cast("string")),
        "MonthlyCharges": F.when(k % 83 == 0, F.lit("")).otherwise(
            F.concat(
                F.lit("$"),
                F.expr("(p % 13000) div 100").cast("string"),
                F.lit("."),
                F.lpad((p % 100).cast("string"), 2, "0"),
            )
        ),
        "TotalCharges": F.when(k % 79 == 0, F.lit(" ")).otherwise(
            F.concat((p % 9000).cast("string"), F.lit(".5"))
        ),
        "SeniorCitizen": F.when(k % 67 == 0, F.lit("2"))
        .when(k % 61 == 0, F.lit(None).cast("string"))
        .otherwise((k % 2).cast("string")),
        "Churn": F.when(k % 71 == 0, F.lit(None).cast("string"))
        .when((k * 7919 + cust) % 100 < CHURN_YES_PERCENT, F.lit("Yes"))
        .otherwise(F.lit("No")),
    }
    for i, name, values in DIRTY_COLUMNS:
        cols[name] = _dirty(i, values)
    return cols


def raw_feeds(spark: SparkSession, sf_dir: str, planted: bool = False, base: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three raw feeds (every column a nullable string), keyed 'features', 'meta', 'labels'.

    ``planted`` swaps the independent label for one with signal (for model tests).  ``base``: the rows of
    ``order_months`` where they are written already, else each feed groups the orders again.
    """
    base = order_months(spark, sf_dir) if base is None else base
    cols = _raw_columns()
    if planted:
        k, cust = F.col("k"), F.col("cust")
        tenure_num = cols["tenure"].try_cast("int")
        cols["Churn"] = (
            F.when(k % 71 == 0, F.lit(None).cast("string"))
            .when(
                ((cols["Contract"] == "Month-to-month") & (tenure_num < PLANTED_TENURE_BELOW))
                | ((k * 7919 + cust) % 100 < PLANTED_YES_PERCENT),
                F.lit("Yes"),
            )
            .otherwise(F.lit("No"))
        )
    return {
        "features": base.select([cols[c].alias(c) for c in RAW_FEATURE_COLUMNS]),
        "meta": base.select([cols[c].alias(c) for c in RAW_META_COLUMNS]),
        "labels": base.select([cols[c].alias(c) for c in RAW_LABEL_COLUMNS]),
    }
