import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from churnlake.llm.mixing import SCHEDULES, invert_schedule, mix, mix_documents, source_targets


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Iterated resharing, as the definition reads."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > most * sizes[s]}
        if not over:
            return {**t, **{s: most * sizes[s] for s in full}}
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 1000}, {"a": 1, "b": 1, "c": 1, "d": 1000, None: 5},
    {"a": 0, "b": 0}, {"é": 100, "z": 100, "Z": 3}, {"only": 7}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_schedule_inversion(spark):
    for knots in SCHEDULES:
        rows = spark.range(101).select((F.col("id") / 100.0).alias("u")).withColumn("t", invert_schedule(knots, F.col("u"))).collect()
        area = lambda t: sum((w0 + (w0 + (w1 - w0) * (min(t, t1) - t0) / (t1 - t0))) / 2 * (min(t, t1) - t0)
                             for (t0, w0), (t1, w1) in zip(knots, knots[1:]) if t > t0)
        for r in rows:
            assert area(r["t"]) / area(1.0) == pytest.approx(r["u"], abs=1e-9)


def plain_mix(rows, whole):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    target, out = plain_targets(sizes), Counter()
    for source in sizes:
        own = sorted((hashlib.md5(str(i).encode()).hexdigest() if i is not None else "", i is not None, i or 0, size_of(t))
                     for i, t, s in rows if s == source)
        goal, at = int(target[source] + 0.5), 0
        takes = Counter()
        for _ in range(3):
            for k, (_, known, i, size) in enumerate(own):
                words = max(0, min(size, goal - at))
                takes[k] += (size if 2 * words >= size else 0) if whole else words
                at += size
        for k, (_, known, i, size) in enumerate(own):
            out[(i if known else None, size, takes[k])] += 1
    return out


@pytest.mark.parametrize("whole", [False, True])
def test_takes(spark, whole):
    rows = [(i, "w " * ((i * 37) % 90), "s" + str(i % 7) if i % 7 < 5 else ("big" if i % 2 else None)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(df, ["doc_id"], whole=whole).collect()
    assert Counter((r["doc_id"], r["size"], sum(t["words"] for t in r["takes"])) for r in got) == plain_mix(rows, whole)
    again = mix(df.repartition(5), ["doc_id"], whole=whole).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    for r in got:
        at = [t["position"] for t in r["takes"]]
        assert at == sorted(at) and all(0 <= x <= 1 for x in at)


def test_odd_rows(odd_docs):
    rows = mix(odd_docs, ["doc_id"]).collect()
    assert len(rows) == odd_docs.count()
    assert all(sum(t["words"] for t in r["takes"]) <= 3 * r["size"] for r in rows)
    copies = mix_documents(odd_docs)
    assert copies.columns == odd_docs.columns
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in copies.collect())
    want = Counter()
    for r, n in plain_mix([(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()], True).items():
        want[r[0]] += n * (r[2] // r[1] if r[1] else 0)
    ids = Counter()
    for (i, _, _), n in got.items():
        ids[i] += n
    assert ids == +want
    assert mix(odd_docs.limit(0), ["doc_id"]).count() == 0 and mix_documents(odd_docs.limit(0)).count() == 0
