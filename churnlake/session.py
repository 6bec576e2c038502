"""Session settings, the shared checkpoint folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on; cluster jobs pass them at submit time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
FILE_ROWS = 250_000     # of one file of a written table


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "churnlake") -> SparkSession:
    """A local session for tests and the bench (the cluster supplies its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               # wide cleaning expressions generate methods above the JVM's 8 KB JIT limit;
               # on a cluster set the same flag in spark.executor.extraJavaOptions
               .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is given by the deployment and is read from the
    session.  Only a local session without one gets a fresh folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no context on the client
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="churnlake-ckpt-"))
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (used to reuse files written in this session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back: for rows that several jobs read.
    Files are limited in rows, so that readers find enough of them to share."""
    path = shared_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs inside run wide projections as many small generated methods.  The JVM interprets a method of more than
    8000 bytes of code, however often it runs, unless it was started with -XX:-DontCompileHugeMethods."""
    before = spark.conf.get(HUGE_METHOD, None)
    spark.conf.set(HUGE_METHOD, "8000")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(HUGE_METHOD)
        else:
            spark.conf.set(HUGE_METHOD, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) into the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
