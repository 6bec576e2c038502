import struct
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from churnlake.llm.sharding import assign_shards, jump_chain


def draw(key, i):
    h = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    return xxhash.xxh64_intdigest(struct.pack("<i", i), h)


def jump(key, n):
    b, j, i = -1, 0, 0
    while j < n:
        b, r = j, ((draw(key, i) >> 33) + 1) / (1 << 31)
        j, i = int((b + 1) / r), i + 1
    return b


def test_against_plain_jump_hash(spark):
    for n in (1, 2, 40, 700):
        got = jump_chain(spark.range(3000).withColumn("k", F.col("id") * 7919 - 5000), F.col("k"), n, "c").collect()
        for r in got:
            assert r["c"]["at"] == jump(r["k"], n)
            assert (n if r["c"]["next"] == n else r["c"]["at"]) == jump(r["k"], n + 1)


def test_growth_moves_only_into_the_new_shard(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    a, b = assign_shards(df, 40), assign_shards(df, 41)
    grown = {r["doc_id"]: r["shard"] for r in b.collect()}
    moved = 0
    for r in a.collect():
        assert r["grown_shard"] == grown[r["doc_id"]] and r["grown_shard"] in (r["shard"], 40)
        moved += r["grown_shard"] == 40
    assert 350 < moved < 640    # 20000 / 41


def test_odd_rows_and_slots(spark, odd_docs):
    rows = assign_shards(odd_docs, 3).collect()
    assert len(rows) == odd_docs.count()
    for shard in range(3):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
                   for r in odd_docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert assign_shards(odd_docs.limit(0), 3).count() == 0
