"""SimHash near-duplicates by anchor-point covering.

A fingerprint is cut into blocks, so many that two fingerprints within the
threshold differ in at most one bit of some block.  A block's anchors are the
words of a perfect Hamming code (times all values of the bits the code does
not reach): covering radius 1.  A fingerprint's home is the one anchor within
radius 1; if a second block differs in one bit it lies within 2 of that
anchor.  So every fingerprint is replicated to all anchors within 2 (covering
radius plus threshold, 17 for a block of 32 bits) and compared, per anchor,
with those at home there: no pair within the threshold is missed.

Equal fingerprints are one node.  Links are found in rounds of growing
threshold, and a round compares only fingerprints that are not yet connected,
so a dense group is connected by near links instead of giving all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import all_of, connected_components, load, put_back, set_apart, text_of
from churnlake.session import checkpoint

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
STEP = 1 << 16      # shingles hashed at a time, whatever the length of the text


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash (signed) of a whole text; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()     # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), SEED)
                           for i in range(at, min(at + STEP, n))], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint_udf(shingle: int):
    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: fingerprint(t, shingle)).astype("int64")

    return simhash


def _shl(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def anchors(block: Column, width: int) -> tuple[Column, Column]:
    """(home anchor, array of all anchors within distance 2) of a block of ``width`` bits."""
    r = (width + 1).bit_length() - 1
    coded = (1 << r) - 1
    free = [1 << b for b in range(coded, width)]
    flips = lambda masks: F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in masks])
    once = [0, *free]
    twice = [*once, *[a | b for i, a in enumerate(free) for b in free[i + 1:]]]
    parity = [F.call_function("shiftleft", F.bit_count(block.bitwiseAND(F.lit(sum(
        1 << (p - 1) for p in range(1, coded + 1) if p >> j & 1)))).bitwiseAND(F.lit(1)), F.lit(j)) for j in range(r)]
    syndrome = parity[0]
    for p in parity[1:]:
        syndrome = syndrome + p
    syndrome = syndrome.cast("int")
    home = F.when(syndrome == 0, block).otherwise(block.bitwiseXOR(_shl(syndrome - 1)))
    # positions a < b with a xor b = syndrome: flipping both gives another word of the code
    pairs = F.filter(F.sequence(F.lit(1), F.lit(coded)), lambda a: a < a.bitwiseXOR(syndrome))
    near = F.transform(pairs, lambda a: block.bitwiseXOR(_shl(a - 1)).bitwiseXOR(_shl(a.bitwiseXOR(syndrome) - 1)))
    return home, F.when(syndrome == 0, F.transform(flips(twice), lambda m: block.bitwiseXOR(m))).otherwise(
        F.concat(F.transform(flips(once), lambda m: home.bitwiseXOR(m)), near))


def links(nodes: DataFrame, distance: int, n_blocks: int) -> DataFrame:
    """(u, v): components of ``nodes`` (fp, comp) that have fingerprints within ``distance`` of each other."""
    width = -(-64 // n_blocks)
    block = [F.shiftrightunsigned("fp", width * k).bitwiseAND(F.lit((1 << min(width, 64 - width * k)) - 1 if width < 64 else -1))
             for k in range(n_blocks)]
    both = [anchors(b, min(width, 64 - width * k)) for k, b in enumerate(block)]
    at = lambda cols: nodes.select("fp", "comp", F.posexplode(F.array(*cols)).alias("block", "anchor"))
    home = at([h for h, _ in both])
    near = at([a for _, a in both]).select(F.col("fp").alias("y"), F.col("comp").alias("v"), F.col("block").alias("y_block"),
                                           F.explode("anchor").alias("y_anchor"))
    met = home.join(near, all_of([
        F.col("block") == F.col("y_block"), F.col("anchor") == F.col("y_anchor"), F.col("comp") != F.col("v"),
        F.col("fp") < F.col("y"), F.bit_count(F.col("fp").bitwiseXOR(F.col("y"))) <= distance]))
    return met.select(F.least("comp", "v").alias("u"), F.greatest("comp", "v").alias("v")).distinct()


def near_duplicate_groups(docs: DataFrame, keys: tuple = ("doc_id",), shingle: int = SHINGLE,
                          max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per document: ``keys``, fp (signed) and group (a fingerprint that names the component).

    Null and wordless texts have fingerprint 0 and are linked like any other; repeated rows stay and
    share a group; an empty table gives no rows.
    """
    if not 0 <= max_distance <= 15:
        raise ValueError("max_distance must be from 0 to 15")
    fps = checkpoint(docs.select(*keys, fingerprint_udf(shingle)(text_of()).alias("fp")))
    nodes = checkpoint(fps.select("fp").distinct().withColumn("comp", F.col("fp")))
    n_blocks = (max_distance + 2) // 2
    for distance in sorted({d for d in (1, 2) if d < max_distance} | {max_distance} - {0}):
        found = connected_components(links(nodes, distance, n_blocks))
        found = found.where("node <> component").select(F.col("node").alias("__n"), "component")
        nodes = checkpoint(nodes.join(found, F.col("comp") == F.col("__n"), "left")
                           .select("fp", F.coalesce("component", "comp").alias("comp")))
    named = nodes.select(F.col("fp").alias("__fp"), F.col("comp").alias("group"))
    return fps.join(named, fps["fp"] == named["__fp"]).select(*keys, "fp", "group")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group: the smallest (doc_id, hash of the text), null ids last.

    Of repeated rows one stays; an empty table gives no rows; extra columns of any name pass through.
    """
    plain, at = set_apart(docs)
    keyed = plain.withColumns({"key_id": F.col(at["doc_id"]), "key_h": F.xxhash64(text_of(at["text"]))})
    groups = checkpoint(near_duplicate_groups(keyed.select("key_id", "key_h", F.col(at["text"]).alias("text")), ("key_id", "key_h"), **options))
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("key_id").isNull().alias("unknown"), "key_id", "key_h")).alias("k"))
    keep = first.select(F.col("k.key_id").alias("keep_id"), F.col("k.key_h").alias("keep_h"))
    out = keyed.join(keep, all_of([F.col("key_h") == F.col("keep_h"), F.col("key_id").eqNullSafe(F.col("keep_id"))]), "left_semi")
    if groups.groupBy("key_id", "key_h").count().where("count > 1").limit(1).count():
        out = out.dropDuplicates(["key_id", "key_h"])       # repeated rows of one document
    return put_back(out, at)


def op4_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    groups = checkpoint(near_duplicate_groups(load(spark, sf_dir, "documents")))
    # pinned, so that the join of a large component is split like any skewed one
    least = checkpoint(groups.groupBy("group").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("group", "__g"))
    return groups.join(least, groups["group"] == least["__g"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
