"""Bronze ingest as Structured Streaming: new raw CSV files -> partitioned bronze.

The same transform as the batch bronze step (parsable snapshot date filter,
columns unchanged), run incrementally: ``trigger(availableNow=True)`` processes
every file not yet seen and stops, so a monthly schedule picks up only the new
drops.  Progress lives in the checkpoint folder, so a lost executor or a
restarted job neither skips nor duplicates files.

``ingest_available`` takes a folder of files that never repeat a month.
``ingest_drops`` takes a folder of drops, sub-folders named in the order of
delivery, in which a later drop may deliver a month again: it then replaces
that month, as a batch run on the drop would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType

from churnlake.schema import RAW_SCHEMAS
from churnlake.sources import feeds
from churnlake.sources.feeds import RAW_CSV_OPTIONS, bronze

_MANIFEST = StructType().add("Snapshot_Date", StringType()).add("drop", StringType()).add("rows", LongType()).add("batch", LongType())
MANIFEST_BYTES = 64 << 20


def bronze_stream(spark: SparkSession, raw_dir: str, feed: str, bronze_path: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(RAW_SCHEMAS[feed]).options(**RAW_CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = bronze(reader.csv(raw_dir))
    return (rows.writeStream.format("csv").option("header", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("checkpointLocation", checkpoint).partitionBy("Snapshot_Date")
            .outputMode("append").trigger(availableNow=True).start(bronze_path))


def ingest_available(spark: SparkSession, raw_dir: str, feed: str, bronze_path: str, checkpoint: str) -> None:
    """Run one availableNow pass and wait for it."""
    q = bronze_stream(spark, raw_dir, feed, bronze_path, checkpoint)
    q.awaitTermination()


def store_batch(batch: DataFrame, batch_id: int, feed: str, path: str) -> None:
    """Write one micro-batch (raw columns and ``drop``) under its batch id, and its months to the manifest.

    Both writes replace the partitions of this batch id only, so a batch that is run again after a failure
    leaves what one run would leave.
    """
    spark = batch.sparkSession
    feeds.write_partitioned(batch.withColumn("batch", F.lit(batch_id).cast("long")), f"{path}/rows", "csv",
                            ["Snapshot_Date", "drop", "batch"], header=True, ignoreLeadingWhiteSpace=False,
                            ignoreTrailingWhiteSpace=False)
    mine = _rows(spark, feed, path).where(F.col("batch") == batch_id)
    counts = mine.groupBy("Snapshot_Date", "drop", "batch").agg(F.count(F.lit(1)).alias("rows"))
    feeds.write_partitioned(counts, f"{path}/manifest", partition_by="batch")


def drop_stream(spark: SparkSession, raw_root: str, feed: str, path: str, checkpoint: str,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream over the files of ``raw_root/<drop>/``."""
    reader = spark.readStream.schema(RAW_SCHEMAS[feed]).options(**RAW_CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(f"{raw_root}/*").select("*", F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1).alias("drop"))
    return (bronze(rows).writeStream.foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, feed, path))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def ingest_drops(spark: SparkSession, raw_root: str, feed: str, path: str, checkpoint: str,
                 max_files_per_trigger: int | None = None) -> None:
    """Ingest every file not yet seen, and wait for the end of the pass."""
    drop_stream(spark, raw_root, feed, path, checkpoint, max_files_per_trigger).awaitTermination()


def _rows(spark: SparkSession, feed: str, path: str) -> DataFrame:
    schema = StructType([*RAW_SCHEMAS[feed].fields]).add("drop", StringType()).add("batch", LongType())
    return spark.read.schema(schema).options(**RAW_CSV_OPTIONS).csv(f"{path}/rows")


def read_drops(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """Bronze rows of ``ingest_drops``: of each month those of the latest drop that holds it, from whichever
    micro-batches its files came in.  The manifest names the partitions, so superseded ones are not opened."""
    months = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").groupBy("Snapshot_Date").agg(F.max("drop").alias("drop"))
    few = months.count() * 128 <= MANIFEST_BYTES
    return _rows(spark, feed, path).join(F.broadcast(months) if few else months, ["Snapshot_Date", "drop"], "left_semi").select(
        *RAW_SCHEMAS[feed].names)
