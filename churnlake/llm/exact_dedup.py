"""Exact deduplication with a Golomb-coded fingerprint exchange.

Rows get a fingerprint of log2(rows) + 16 bits.  Chunks of rows send their
sorted distinct fingerprints, as Golomb-Rice coded gaps, to the owners of
fingerprint ranges; an owner answers each chunk with a bitmap of those that
another chunk has too.  Only rows with a marked fingerprint (and those equal
inside a chunk) are suspects; their texts alone are shuffled, grouped by their
bytes with a partial aggregate, and give the group sizes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import SPACE, broadcast_if_small, load, shuffle_width, text_of
from churnlake.session import checkpoint

CHUNK_BITS = 20         # a chunk holds up to 2**20 rows of one partition
OWNER_ROWS = 1 << 20    # fingerprints an owner may expect
EXTRA_BITS = 16         # a row without a copy is a suspect with a chance of about 2**-16


def rice_encode(gaps: np.ndarray, k: int) -> tuple[bytes, bytes]:
    """Golomb-Rice code of non-negative gaps with parameter 2**k: unary quotients, then k-bit remainders."""
    quotients = (gaps >> k).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    rest = (gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1
    return np.packbits(unary).tobytes(), np.packbits(rest.astype(np.uint8).ravel()).tobytes()


def rice_decode(unary: bytes, rest: bytes, n: int, k: int) -> np.ndarray:
    zeros = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    quotients = np.diff(zeros, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(rest, np.uint8))[:n * k].reshape(n, k).astype(np.int64)
    return (quotients.astype(np.int64) << k) | (bits @ (1 << np.arange(k - 1, -1, -1, dtype=np.int64)))


def _senders(owner_shift: int):
    """Per partition: one coded message for each chunk and owner."""
    def message(chunk: int, fps: np.ndarray) -> pa.RecordBatch:
        fps = np.unique(fps)
        owners = fps >> owner_shift
        cuts = np.flatnonzero(np.diff(owners, prepend=-1))
        rows = []
        for part in np.split(fps, cuts[1:]):
            owner = int(part[0] >> owner_shift)
            gaps = np.diff(part, prepend=owner << owner_shift)
            k = max(0, int(math.log2((1 << owner_shift) / len(part))))
            rows.append((owner, chunk, len(part), k, *rice_encode(gaps, k)))
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int32()),
            pa.array([r[4] for r in rows], pa.binary()), pa.array([r[5] for r in rows], pa.binary())],
            names=["owner", "chunk", "n", "k", "unary", "rest"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            chunks, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for part in np.split(np.arange(len(chunks)), np.flatnonzero(np.diff(chunks)) + 1):
                if not len(part):
                    continue
                if now is not None and chunks[part[0]] != now:
                    yield message(now, np.concatenate(held))
                    held = []
                now = int(chunks[part[0]])
                held.append(fps[part])
        if held:
            yield message(now, np.concatenate(held))

    return send


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps: which fingerprints of each message came from more than one chunk."""
    parts = [np.cumsum(rice_decode(m.unary, m.rest, m.n, m.k)) for m in messages.itertuples()]
    _, place, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = np.split(count[place] > 1, np.cumsum([len(p) for p in parts])[:-1])
    return pd.DataFrame({"chunk": messages["chunk"], "owner": messages["owner"], "n": messages["n"],
                         "bitmap": [np.packbits(s).tobytes() for s in shared]})


def _mark(rows: pa.Table, bitmaps: pa.Table) -> pa.Table:
    """A chunk's rows with the owners' answers applied; copies inside the chunk need no answer."""
    values, place, count = np.unique(rows.column("fp").to_numpy(), return_inverse=True, return_counts=True)
    answers = sorted(zip(bitmaps.column("owner").to_pylist(), bitmaps.column("n").to_pylist(), bitmaps.column("bitmap").to_pylist()))
    shared = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8))[:n] for _, n, b in answers] or [np.zeros(0, np.uint8)])
    if len(shared) != len(values):
        raise ValueError("an owner's answer is missing")
    return rows.append_column("suspect", pa.array(((shared > 0) | (count > 1))[place]))


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (hex).

    Null texts count as empty and are copies of each other; of equal texts the smallest doc_id stays
    (null ids last, among rows that repeat it the one read first), so exactly one row of a group is kept.
    """
    spark = docs.sparkSession
    text = normalised(text_of())
    rows = checkpoint(docs.select(
        F.col("doc_id"), F.monotonically_increasing_id().alias("at"), F.unhex(F.sha2(text, 256)).alias("sha"),
        F.xxhash64(text).alias("h")))
    n = rows.count()
    owner_bits = max(0, math.ceil(math.log2(max(shuffle_width(spark), n / OWNER_ROWS))))
    bits = min(62, max(owner_bits, math.ceil(math.log2(max(n, 2)))) + EXTRA_BITS)
    rows = rows.withColumns({"fp": F.shiftrightunsigned("h", 64 - bits), "chunk": F.shiftrightunsigned("at", CHUNK_BITS)})
    messages = rows.select("chunk", "fp").mapInArrow(
        _senders(bits - owner_bits), "owner long, chunk long, n int, k int, unary binary, rest binary")
    bitmaps = messages.groupBy("owner").applyInPandas(_answer, "chunk long, owner long, n int, bitmap binary")
    marked = checkpoint(rows.groupBy("chunk").cogroup(bitmaps.groupBy("chunk")).applyInArrow(
        _mark, "doc_id long, at long, sha binary, h long, fp long, chunk long, suspect boolean").drop("fp", "chunk"))
    suspects = marked.where("suspect")
    wanted = broadcast_if_small(suspects.select(F.col("h").alias("__h")).distinct(), 16)
    texts = docs.select(text.alias("norm")).withColumn("h", F.xxhash64("norm"))
    verified = (texts.join(wanted, F.col("h") == F.col("__h"), "left_semi").groupBy("norm").agg(F.count(F.lit(1)).alias("same"))
                .select(F.unhex(F.sha2("norm", 256)).alias("v_sha"), "same"))
    groups = suspects.groupBy(F.col("sha").alias("g_sha")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "at")).alias("first"),
        F.count(F.lit(1)).alias("n"))
    # checkpointed, so that the join below shuffles both sides for itself and AQE can split a hot text
    groups = checkpoint(groups.join(verified, F.col("g_sha") == F.col("v_sha"), "left").select(
        "g_sha", "first", F.when(F.col("n") == F.col("same"), F.col("n"))
        .otherwise(F.raise_error(F.lit("texts with one SHA-256 differ")).cast("bigint")).alias("n")))
    copies = suspects.join(groups, F.col("sha") == F.col("g_sha")).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("at") == F.col("first.at")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    single = marked.where("NOT suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    return single.union(copies)


def op6_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return exact_groups(load(spark, sf_dir, "documents"))
