"""Centroid clustering with an incremental matrix of dot products.

Vectors are turned into integers, so every sum and product is exact.  Each
vector's row holds its squared length and its dot product with every centroid,
and is written to the shared folder after each round.  A round adds up each
cluster's members (partial sums per task), floors the means on the driver,
which holds centroids only, and updates a dot product by the centroid's
components that changed, times the vector's; unchanged centroids and
components cost nothing.  The nearest centroid then follows from the squared
lengths and the dot products.  No vector is shuffled.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component are left out; components whose integer would be 2**26 or
more raise, as distances could pass 64 bits; a null id counts as empty text in
the choice of the first centroids; equal hashes there are ordered by id (null
first) and vector; repeated rows are vectors of their own; with fewer vectors
than centroids there are as many centroids as vectors; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import load
from churnlake.session import checkpoint, shared_path

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
LARGEST = 1 << 26
_STATE = "vec_id {id}, x array<int>, square long, dots array<long>, cluster int, distance long"


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the usable vectors as integers floor(scale * component)."""
    e = F.col("embedding")
    inf = F.lit(float("inf")).cast("double")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < inf))
    whole = F.transform(e, lambda v: F.when(F.abs(v.cast("double")) * scale < LARGEST, F.floor(v.cast("double") * scale).cast("int"))
                        .otherwise(F.raise_error(F.lit("component too large for exact distances")).cast("int")))
    return vectors.select("vec_id", e).where((F.size(e) == dimensions) & fine).select("vec_id", whole.alias("x"))


def first_centroids(rows: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The k vectors with the smallest hash of ``1:<vec_id>``."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    picked = rows.select("x", "vec_id", key.alias("key")).orderBy("key", "vec_id", "x").limit(k).collect()
    return np.array([r["x"] for r in picked], np.int64)


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact x @ c.T; in floating point where no sum can leave its exact range."""
    bound = x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(c).max(initial=0))
    if bound < 1 << 53:
        return (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return x @ c.T


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, max(1, values.shape[1])), pa.int32()),
                                    pa.array(values.ravel(), kind))


def _nearest(ids: pa.Array, x: pa.Array, square: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    distance = square[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)[None, :]
    cluster = distance.argmin(axis=1)       # the first of equal ones
    return pa.RecordBatch.from_arrays(
        [ids, x, pa.array(square, pa.int64()), _lists(dots, pa.int64()), pa.array(cluster, pa.int32()),
         pa.array(distance[np.arange(len(cluster)), cluster], pa.int64())],
        names=["vec_id", "x", "square", "dots", "cluster", "distance"])


def _begin(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1), b.num_rows)
                yield _nearest(b.column(0), b.column(1), (x * x).sum(axis=1), products(x, centroids), centroids)

    return run


def changes(old: np.ndarray, new: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(centroid, components, differences) of the centroids that moved."""
    out = []
    for c in range(len(old)):
        at = np.flatnonzero(old[c] != new[c])
        if len(at):
            out.append((c, at, new[c, at] - old[c, at]))
    return out


def _update(moved: list[tuple[int, np.ndarray, np.ndarray]], centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1), b.num_rows)
                dots = _matrix(b.column(3), b.num_rows)
                for c, at, by in moved:
                    dots[:, c] += products(x[:, at], by[None, :])[:, 0]
                yield _nearest(b.column(0), b.column(1), b.column(2).to_numpy(), dots, centroids)

    return run


def _sums(k: int, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for b in batches:
            if b.num_rows:
                x, cluster = _matrix(b.column(0), b.num_rows), b.column(1).to_numpy()
                for c in np.unique(cluster):
                    mine = x[cluster == c]
                    count[c] += len(mine)
                    total[c] += mine.sum(axis=0)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some], pa.int64()),
                                          _lists(total[some], pa.int64())], names=["cluster", "n", "total"])

    return run


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster; empty ones keep their centroid."""
    k, dimensions = centroids.shape
    parts = state.select("x", "cluster").mapInArrow(_sums(k, dimensions), "cluster int, n long, total array<long>")
    # at most k rows come back
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(F.get("total", F.lit(j))) for j in range(dimensions)]).alias("total")).collect()
    out = centroids.copy()
    for r in rows:
        out[r["cluster"]] = [t // r["n"] for t in r["total"]]
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(state, centroids) after ``rounds`` updates: one row per usable vector with vec_id, x, square, dots,
    cluster and distance."""
    spark = vectors.sparkSession
    rows = checkpoint(integer_vectors(vectors, dimensions, scale))
    schema = _STATE.format(id=rows.schema["vec_id"].dataType.simpleString())
    centroids = first_centroids(rows, k)
    if not len(centroids):
        return spark.createDataFrame([], schema), np.zeros((0, dimensions), np.int64)

    def written(df: DataFrame) -> DataFrame:
        path = shared_path(spark, "clustering")
        df.write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    state = written(rows.mapInArrow(_begin(centroids), schema))
    for _ in range(rounds):
        new = means(state, centroids)
        moved = changes(centroids, new)
        if not moved:
            break               # no round can change anything any more
        state, centroids = written(state.mapInArrow(_update(moved, new), schema)), new
    return state, centroids


def op13_incremental_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all usable embeddings."""
    state, centroids = cluster(load(spark, sf_dir, "embeddings"))
    sums = {r["cluster"]: r["s"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = F.array(*[F.lit(sums.get(i, 0)).cast("bigint") for i in range(len(centroids))]).cast("array<bigint>")
    said = F.array(*[F.lit(d) for d in digests]).cast("array<string>")
    return state.select("vec_id", "cluster", "distance", F.get(per, F.col("cluster")).alias("cluster_inertia"),
                        F.lit(sum(sums.values())).cast("bigint").alias("inertia"), F.get(said, F.col("cluster")).alias("centroid_sha256"))
