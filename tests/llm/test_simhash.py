import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnlake.llm.common import connected_components
from churnlake.llm.queries import QUERIES
from churnlake.llm.simhash import anchors, deduplicate, links, near_duplicate_groups


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def closure(pairs, nodes):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)] + [(999, i) for i in range(500, 560)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == closure(pairs, {n for p in pairs for n in p})


@pytest.mark.parametrize("width", [32, 64, 22, 16])
def test_covering(spark, width):
    rng = np.random.default_rng(1)
    mask = (1 << width) - 1
    xs = [int(x) & mask for x in rng.integers(0, 1 << 63, 40, dtype=np.int64)] + [0, mask]
    rows = [(signed(x), signed(x ^ (1 << b if b >= 0 else 0))) for x in xs for b in range(-1, width)]
    df = spark.createDataFrame(rows, "x long, y long")
    home, _ = anchors(F.col("x"), width)
    _, near = anchors(F.col("y"), width)
    assert df.where(~F.array_contains(near, home)).count() == 0
    assert df.where(F.bit_count(F.col("x").bitwiseXOR(home)) > 1).count() == 0


@pytest.mark.parametrize("distance", [1, 2, 3, 5])
def test_links_are_all_pairs(spark, distance):
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, distance + 2)):
                f ^= 1 << b
            fps.add(f)
    df = spark.createDataFrame([(signed(f), signed(f)) for f in fps], "fp long, comp long")
    got = {(r["u"], r["v"]) for r in links(df, distance, (distance + 2) // 2).collect()}
    assert got == {tuple(sorted((signed(a), signed(b)))) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= distance}


def plain_groups(rows):
    fps = {f for _, f in rows}
    comp = closure([(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3], fps)
    least = defaultdict(lambda: None)
    for i, f in rows:
        if i is not None and (least[comp[f]] is None or i < least[comp[f]]):
            least[comp[f]] = i
    return Counter((i, f"{f:016x}", least[comp[f]]) for i, f in rows)


def test_query_against_all_pairs(spark, odd_docs, write_tables):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=300)
        for _ in range(6):
            new = list(base)
            for _ in range(rng.randint(0, 3)):
                new[rng.randrange(len(new))] = rng.choice(words)
            texts.append(rng.choice([" ", "\n", " \t"]).join(new))
    docs = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    got = QUERIES["op4_simhash_neardup"](spark, write_tables(documents=docs)).collect()
    assert Counter(map(tuple, got)) == plain_groups(rows)
    kept = deduplicate(docs).collect()
    assert len(kept) == len({c for _, _, c in plain_groups(rows)})


def test_odd_rows(odd_docs):
    assert near_duplicate_groups(odd_docs).count() == odd_docs.count()
    assert deduplicate(odd_docs).columns == odd_docs.columns
    assert near_duplicate_groups(odd_docs.limit(0)).count() == 0 and deduplicate(odd_docs.limit(0)).count() == 0
