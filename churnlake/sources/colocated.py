"""Stores bucketed and sorted on the customer, so that joins between them need no exchange.

A bucketed store is partitioned by month and, inside a month, split into the
same number of buckets by hash of customerID.  A customer has at most one row a
month, so no bucket is hot.  Two such stores meet bucket by bucket: a join on
(customerID, Snapshot_Date) finds both sides already dealt out by customerID.

Spark accepts that layout for a join on more keys than the bucketed one when
``spark.sql.requireAllClusterKeysForCoPartition`` is false (``COLOCATED_CONF``);
otherwise the join is planned with its usual exchanges and gives the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.session import shared_path

BUCKET_KEY, MONTH = "customerID", "Snapshot_Date"
COLOCATED_CONF = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # the planner otherwise drops the bucketed scan where it sees no use in it
    "spark.sql.sources.bucketing.enabled": "true",
}


def create_store(spark: SparkSession, name: str, like: DataFrame, buckets: int, path: str | None = None) -> str:
    """An empty bucketed store with the columns of ``like``; its table name (``name`` and a random suffix).

    ``buckets`` must be the same for all stores that are to be joined: about a month's bytes / 128 MB.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (like.limit(0).write.format("parquet").partitionBy(MONTH).bucketBy(buckets, BUCKET_KEY)
     .sortBy(BUCKET_KEY).option("path", path or shared_path(spark, name)).saveAsTable(table))
    return table


def write_months(df: DataFrame, table: str, buckets: int) -> None:
    """Replaces the months that ``df`` holds; the others stay.

    The rows are dealt out by month and bucket first, so that a task writes few files: a bucket of a month is one
    file, which later scans read as it is.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    dealt = df.select(*columns).repartition(MONTH, F.pmod(F.hash(BUCKET_KEY), F.lit(buckets)))
    dealt.write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)


def gold_join(spark: SparkSession, features: str, meta: str, labels: str | None = None) -> DataFrame:
    """features ⨝ meta (⨝ labels) of bucketed stores on customer and month, keys first and once.

    The merge hint keeps the bucketed layout in use whatever the sizes: no side is broadcast or shuffled.
    """
    keys = [BUCKET_KEY, MONTH]
    out = spark.table(features).hint("merge").join(spark.table(meta).hint("merge"), keys, "inner")
    return out if labels is None else out.join(spark.table(labels).hint("merge"), keys, "inner")


def drop_store(spark: SparkSession, table: str) -> None:
    """Forgets the table; its files stay where they are (they belong to the shared folder)."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
