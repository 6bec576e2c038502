import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from churnlake.llm import clustering
from churnlake.llm.clustering import changes, cluster, op13_incremental_clusters, products


def plain(vectors, k, rounds, dimensions, scale):
    """(vec_id, cluster, distance) of each usable vector, and the centroids."""
    rows = [(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in vectors
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]

    def digest(i):
        return hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()

    cents = [x for _, x in sorted(rows, key=lambda r: (digest(r[0]), r[0] is not None, r[0] or 0, r[1]))[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in rows]
        for j in range(len(cents)):
            mine = [x for (_, x), o in zip(rows, own) if o == j]
            if mine:
                cents[j] = tuple(sum(col) // len(mine) for col in zip(*mine))
    return Counter((i, *reversed(nearest(x))) for i, x in rows), [list(c) for c in cents]


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 9, "x") for i, v in vectors], "vec_id long, embedding array<float>, cluster int, dots string")


@pytest.mark.parametrize("seed,n,k", [(1, 300, 5), (2, 40, 7), (3, 3, 4)])
def test_against_plain_rounds(spark, seed, n, k):
    rng = random.Random(seed)
    vectors = [(i, [np.float32(rng.choice([-2, -1.5, 0, 0.015, 1]) + rng.random() / 4).item() for _ in range(4)]) for i in range(n)]
    vectors += [(n // 2, vectors[0][1])] * 20 + [(0, vectors[0][1])] + [(None, [0.5] * 4)] * 2      # ties, repeated rows
    vectors += [(900, None), (901, [1.0] * 3), (902, [1.0, None, 0.0, 0.0]), (903, [math.nan] * 4), (904, [math.inf] * 4), (905, [])]
    state, cents = cluster(frame(spark, vectors).repartition(5), k, 3, 4, 64)
    want, centroids = plain(vectors, k, 3, 4, 64)
    assert Counter(map(tuple, state.select("vec_id", "cluster", "distance").collect())) == want
    assert cents.tolist() == centroids


def test_persisted_products_are_those_of_the_centroids(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(200)]
    state, cents = cluster(frame(spark, vectors), 4, 3, 8, 64)
    for r in state.collect():
        assert r["dots"] == (cents @ np.array(r["x"], np.int64)).tolist()
        assert r["square"] == sum(v * v for v in r["x"])


def test_exact_beyond_floating_point():
    x = np.array([[(1 << 26) - 1, -(1 << 26) + 1, 3]], np.int64)
    assert products(x, x)[0, 0] == sum(int(v) ** 2 for v in x[0])
    assert [(c, a.tolist(), d.tolist()) for c, a, d in changes(np.array([[1, 2], [3, 4]]), np.array([[1, 2], [3, 9]]))] == [(1, [1], [5])]


def test_large_components_raise(spark):
    with pytest.raises(Exception, match="too large"):
        cluster(frame(spark, [(1, [1e9, 0.0])]), 1, 1, 2, 64)


def test_query_and_empty_table(spark, write_tables):
    rng = np.random.default_rng(6)
    vectors = frame(spark, [(i, rng.normal(size=64).astype(np.float32).tolist()) for i in range(100)])
    out = op13_incremental_clusters(spark, write_tables(embeddings=vectors)).collect()
    assert len(out) == 100 and {r["inertia"] for r in out} == {sum(r["distance"] for r in out)}
    for r in out:
        assert r["cluster_inertia"] == sum(o["distance"] for o in out if o["cluster"] == r["cluster"])
    assert op13_incremental_clusters(spark, write_tables(embeddings=vectors.limit(0))).count() == 0
    assert clustering.CENTROIDS == 16
