"""Helpers shared by the operators of this subpackage.

Conventions: a null text counts as an empty text; operators select the columns
they need first, so extra columns never clash with internal names; sides are
broadcast only where a parameter bounds them or after ``broadcast_if_small``
has measured them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake.session import checkpoint, ensure_checkpoint_dir, shared_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"          # of text whose A-Z are lower-cased
BLACK = r"[^\x20\x09-\x0D]+"                        # between white space
SPACE = r"[\x20\x09-\x0D]+"
BROADCAST_BYTES = 64 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: like a checkpoint it cuts lineage and survives
    lost executors, but it is compressed, and a later pass reads only the columns it needs."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c_0, c_1, ..., and the new name of each, so that columns an operator adds
    clash with none, whatever they are called."""
    at = {c: f"c_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*at.values()), at


def put_back(df: DataFrame, at: dict[str, str]) -> DataFrame:
    """The columns of ``set_apart`` under their own names, without any others."""
    return df.select(*[F.col(c).alias(name) for name, c in at.items()])


def text_of(col: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept (``lower`` is only used where they agree)."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def words_of(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def literal_rows(spark: SparkSession, rows: list[Column], schema: str) -> DataFrame:
    """A table of literal structs (parameters, not data)."""
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*rows)))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows times ``row_bytes`` stay under ``limit``;
    without a hint, so joined by a shuffle, beyond that."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def _ranged(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartitionByRange(shuffle_width(df.sparkSession), *keys)


def range_index(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name``: the row's gapless number from 0 within its group, in ``order`` order.

    The rows are range-partitioned on (group, order), so a group may span any
    number of tasks; inside a partition the row's place comes from
    ``monotonically_increasing_id`` after the sort, and one small row per
    (partition, group) gives each slice its offset.  Equal keys are numbered in
    arbitrary order.  ``df`` should be narrow: it is checkpointed.
    """
    keys = [*group, *order]
    at = checkpoint(_ranged(df, keys).sortWithinPartitions(*keys)
                    .withColumn("__at", F.monotonically_increasing_id())
                    .withColumn("__pid", F.spark_partition_id()))
    slices = at.groupBy("__pid", *group).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        F.col("__pid").alias("__opid"), *[F.col(g).alias(f"__o_{g}") for g in group],
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    same = all_of([at["__pid"] == offsets["__opid"], *[at[g].eqNullSafe(offsets[f"__o_{g}"]) for g in group]])
    # at most one row per partition and group
    return (at.join(broadcast_if_small(offsets, 64), same, "inner")
            .select(*df.columns, (F.col("__at") + F.col("__shift")).alias(name)))


def running_before(df: DataFrame, group: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Adds ``<v>_before`` for each value: its sum over the earlier rows of the group in ``order``
    order, without one task per group (range partitions, then offsets as in ``range_index``)."""
    keys = [*group, *order]
    at = checkpoint(_ranged(df, keys).withColumn("__pid", F.spark_partition_id()))
    local = Window.partitionBy("__pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = at.groupBy("__pid", *group).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    before = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("__pid").alias("__opid"), *[F.col(g).alias(f"__o_{g}") for g in group],
        *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__b_{v}") for v in values])
    inner = at.select("*", *[F.coalesce(F.sum(v).over(local), F.lit(0)).alias(f"__l_{v}") for v in values])
    same = all_of([inner["__pid"] == offsets["__opid"], *[inner[g].eqNullSafe(offsets[f"__o_{g}"]) for g in group]])
    return (inner.join(broadcast_if_small(offsets, 64), same, "inner")
            .select(*df.columns, *[(F.col(f"__l_{v}") + F.col(f"__b_{v}")).alias(f"{v}_before") for v in values]))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): component is its smallest reachable node.

    Alternating large-star and small-star rounds (each a partial aggregate and
    a join, so a hub is split like any hot key); every round is checkpointed
    and the loop ends when neither step changes the edge set.  Self-loops only
    declare a node; null ends are dropped.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    pairs = edges.select("u", "v").where("u IS NOT NULL AND v IS NOT NULL")
    nodes = pairs.select("u").union(pairs.select("v")).distinct()
    e = checkpoint(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    def star(sym: DataFrame, larger_only: bool) -> DataFrame:
        low = sym.groupBy("u").agg(F.min("v").alias("__m")).select(
            F.col("u").alias("__u"), F.least("u", "__m").alias("__m"))
        joined = sym.join(low, sym["u"] == low["__u"])
        if larger_only:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("__m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("__m").alias("v")).union(
                low.select(F.col("__u").alias("u"), F.col("__m").alias("v")))
        return out.where("u <> v").distinct()

    seen = mark(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, True)
        e = checkpoint(star(large, False))
        now = mark(e)
        if now == seen:
            break
        seen = now
    found = e.select(F.col("u").alias("__n"), F.col("v").alias("__c"))
    return (nodes.join(found, nodes["u"] == found["__n"], "left")
            .select(F.col("u").alias("node"), F.coalesce("__c", "u").alias("component")))
