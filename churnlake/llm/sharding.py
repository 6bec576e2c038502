"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A key walks a chain of jumps 0 = b0 < b1 < ...: from bucket b the next one is
floor((b + 1) / r) for a random r in (0, 1] that depends on the key and the
step alone.  With n shards the key belongs to the last bucket of its chain
below n, so no ring table is kept and one more shard takes its share of keys
and moves nothing else.  The random numbers are the key's xxhash64 with the
step.  Everything is a column expression; the only shuffle numbers the slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import load, range_index, text_of
from churnlake.session import checkpoint

UNROLLED = 48       # steps tried before the (lazy) full-length walk; a chain has about ln(n) steps
ROW_OVERHEAD = 16   # bytes a row takes besides its text


def _walk(start: Column, key: Column, first: int, steps: int, n: int) -> Column:
    def step(state: Column, i: Column) -> Column:
        r = (F.shiftrightunsigned(F.xxhash64(key, i), 33).cast("double") + 1.0) / float(1 << 31)
        jump = F.floor((state["next"].cast("double") + 1.0) / r).cast("bigint")
        return F.when(state["next"] >= n, state).otherwise(
            F.struct(state["next"].alias("at"), jump.alias("next")))

    return F.aggregate(F.sequence(F.lit(first), F.lit(first + steps - 1)), start, step)


def jump_chain(df: DataFrame, key: Column, n_shards: int, name: str) -> DataFrame:
    """Adds struct ``name`` (at, next): the key's bucket among ``n_shards`` and the next of its chain.

    The key's bucket among n + 1 is ``next`` if that equals n, else ``at``.  A
    chain is at most n long: keys that have not passed n after ``UNROLLED``
    steps go on to the end.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    zero = F.struct(F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("next"))
    head = min(UNROLLED, n_shards)
    df = df.withColumn(name, _walk(zero, key, 0, head, n_shards))
    if n_shards > head:
        df = df.withColumn(name, F.when(F.col(name)["next"] >= n_shards, F.col(name)).otherwise(
            _walk(F.col(name), key, head, n_shards - head, n_shards)))
    return df


def assign_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Null ids hash like any other value and so share a shard; a null text has no
    bytes (size 16, CRC 0); repeated rows get slots of their own; slots follow
    (doc_id, size, CRC), nulls first; an empty table gives no rows.
    """
    text = text_of(text_col)
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    narrow = jump_chain(narrow, F.col("doc_id"), n_shards, "chain")
    placed = narrow.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"),
        F.col("chain.at").cast("int").alias("shard"),
        F.when(F.col("chain.next") == n_shards, F.lit(n_shards)).otherwise(F.col("chain.at")).cast("int").alias("grown_shard"))
    # narrow rows are pinned first: the range shuffle samples its input, which would read the texts twice
    placed = range_index(checkpoint(placed), ["shard"], ["doc_id", "size", "text_crc32"], "slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("bigint").alias("slot"), "grown_shard")


def op10_jump_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 shards by their ids."""
    return assign_shards(load(spark, sf_dir, "documents"), 40)
