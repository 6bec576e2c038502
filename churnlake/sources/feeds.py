"""Scans and sinks of the datamart: raw CSV feeds, bronze/silver/gold tables, predictions.

Tables are Hive-style partitioned by snapshot date, so a date filter prunes
directories instead of opening files, and a backfill of any number of months
is one job with dynamic partition overwrite (untouched months stay as they
are; re-running a month replaces only that month).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlake.functions.cleaning import text_to_date
from churnlake.schema import RAW_SCHEMAS


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, required: list[str], name: str) -> DataFrame:
    """Schema guard: raise when a required column is absent (no job is run)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"{name} missing required columns: {missing}")
    return df


def validate_nonempty(df: DataFrame, required: list[str], name: str) -> DataFrame:
    """Required columns present and at least one row (a LIMIT 1 probe, not a count)."""
    require_columns(df, required, name)
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df


# '' and null are told apart: the null token is a NUL character that never occurs in text
RAW_CSV_OPTIONS = {"header": True, "nullValue": "\u0000"}


def read_raw_csv(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Raw feed CSV with header, every column a nullable string (no inference pass).

    Only unquoted empty fields are null; a quoted empty field stays '' (the
    null token is a NUL character that never occurs in text).
    """
    return spark.read.schema(RAW_SCHEMAS[feed]).options(**RAW_CSV_OPTIONS).csv(path)


def write_raw_csv(df: DataFrame, path: str, **options) -> None:
    """A raw feed drop: header, values byte for byte (no whitespace trimming)."""
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).options(**options).csv(path))


def read_csv_typed(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV with an explicit schema (or inferred types when none is given)."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def month_calendar(df: DataFrame, date_col: str = "Snapshot_Date") -> DataFrame:
    """One row per month start between the first and last snapshot (``sequence`` of months)."""
    d = text_to_date(F.col(date_col)) if dict(df.dtypes)[date_col] == "string" else F.col(date_col)
    bounds = df.agg(F.trunc(F.min(d), "month").alias("lo"), F.trunc(F.max(d), "month").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("snapshot_date"))


def bronze(raw: DataFrame, snapshots: list[str] | None = None) -> DataFrame:
    """Raw rows whose Snapshot_Date parses as yyyy-MM-dd (and is listed, when a list is given)."""
    require_columns(raw, ["Snapshot_Date"], "raw feed")
    d = text_to_date("Snapshot_Date")
    cond = d.isNotNull()
    if snapshots:
        cond = cond & d.isin([F.to_date(F.lit(s)) for s in snapshots])
    return raw.where(cond)


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | list[str] = "Snapshot_Date",
                      rebalance: bool = True, **options) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition overwrite).

    The rows are rebalanced on ``partition_by`` first: a partition gets few files, and one that holds a large
    part of the rows is split over several tasks.  ``rebalance=False``: rows that are read from a store with the
    same partitions lie together already, and are not shuffled again.
    """
    by = [partition_by] if isinstance(partition_by, str) else partition_by
    rows = df.hint("rebalance", *[F.col(c) for c in by]) if rebalance else df
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .options(**options).partitionBy(*by).format(fmt).save(path))


def write_bronze(df: DataFrame, path: str) -> None:
    """Bronze CSV: header, values kept byte for byte (no whitespace trimming)."""
    write_partitioned(df, path, "csv", header=True, ignoreLeadingWhiteSpace=False,
                      ignoreTrailingWhiteSpace=False)


def read_bronze(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Bronze CSV back as all strings; Snapshot_Date comes from the partition directory.

    Only unquoted empty fields are null; a quoted empty field stays '' (the
    reader's null token is set to a NUL character that never occurs in text).
    """
    return read_raw_csv(spark, path, feed)


def read_store(spark: SparkSession, path: str, glob: str | None = None, merge_schema: bool = False,
               schema: StructType | None = None) -> DataFrame:
    """Parquet store scan (all snapshots; filters on Snapshot_Date prune partitions).  With ``schema`` a
    store without rows reads as an empty table, and the columns keep the schema's order."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    store = reader.parquet(path)
    return store if schema is None else store.select(*schema.names)


def nonempty_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> list[str]:
    """Paths of non-empty files under ``path`` (content is never read, only listed)."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", True).load(path).select("path", "length"))
    return [r.path for r in listing.where(F.col("length") > 0).select("path").collect()]


def has_files(spark: SparkSession, path: str, glob: str) -> bool:
    """Whether a file of that name pattern lies anywhere under ``path`` (listed, not read)."""
    try:
        listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                   .option("recursiveFileLookup", True).load(path).select("path"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return not listing.isEmpty()


def read_predictions(spark: SparkSession, path: str, csv_path: str | None = None) -> DataFrame:
    """Predictions under ``path``: Parquet (partition columns discovered) where there are such files, else
    the CSV copy under ``csv_path`` (default: the same folder).  A fault in a Parquet file is raised."""
    if has_files(spark, path, "*.parquet"):
        return spark.read.parquet(path)
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
            .option("header", True).option("inferSchema", True).csv(csv_path or path))


def write_predictions(df: DataFrame, path: str, csv_copy: str | None = None) -> None:
    """Predictions partitioned by model and snapshot; optional CSV copy written by the executors."""
    write_partitioned(df, path, partition_by=["model_name", "snapshot_date"])
    if csv_copy:
        df.write.mode("overwrite").option("header", True).csv(csv_copy)
