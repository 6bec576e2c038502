"""Quality by votes of the nearest labelled documents in a latent-semantic space.

Terms are hashed: words, word shapes (runs of letters, capitals and digits as
one sign each, other signs as they are), pairs of shapes, and repeats of the
word before.  Their document frequencies are counted over the whole corpus.  A
truncated SVD of the weighted labelled sample gives the latent axes.  The
labelled vectors, at most ``MAX_LABELLED`` of ``RANK`` numbers, are broadcast;
every document's cosine products with all of them are computed exactly, block
by block, and the ``NEIGHBOURS`` nearest (and any as near as the last) vote
for their label with their similarity as weight.

Defined results: a null text is an empty one; a text without words, or with
none in common with the labelled ones, scores the labelled share of label 1
(0.5 without labels); texts of any length are read whole, in blocks; repeated
rows are documents of their own, equal texts score alike; a label for an id
that occurs twice is the larger one, and null labels are left out; of the
labelled rows those with the smallest hash of their id are taken, ties by id;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import load, text_of
from churnlake.llm.tokens import LOWER, SPACE, buffers, hash_words, mixed, pieces, word_table

MAX_LABELLED = 3000     # labelled rows that are fitted on and broadcast
DIMENSIONS = 4096       # hashed terms
RANK = 48               # latent axes
NEIGHBOURS = 25
SHARPNESS = 4           # power of the similarity in a vote
THRESHOLD = 0.5
BLOCK_BYTES = 1 << 19   # of texts that are counted in one go
# sign of a byte in a word's shape; 0 is left out
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x30:0x3A] = 0x30
_SHAPE[0x41:0x5B] = 0x41
_SHAPE[0x61:0x7B] = 0x61
_SHAPE[0x80:] = 0


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's shape; letters outside ASCII count as the letters next to them."""
    signs = _SHAPE[data]
    signs[SPACE[data]] = 0
    places = np.flatnonzero(signs)
    word = np.searchsorted(starts, places, side="right") - 1
    new = np.ones(len(places), bool)
    new[1:] = (signs[places[1:]] != signs[places[:-1]]) | (word[1:] != word[:-1])
    places, word = places[new], word[new]
    first = np.searchsorted(word, np.arange(len(starts)))
    last = np.searchsorted(word, np.arange(len(starts)), side="right")
    out = np.zeros(len(starts), np.uint64)
    some = last > first
    out[some] = hash_words(signs[places], first[some], last[some])
    return out


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, DIMENSIONS) counts of the hashed terms of a block of texts."""
    n = len(offsets) - 1
    starts, ends, row = word_table(data, offsets)
    words = hash_words(LOWER[data], starts, ends)
    shapes = _shapes(data, starts, ends)
    again = row[1:] == row[:-1]
    pairs = mixed(shapes[:-1] * np.uint64(3) + shapes[1:])[again]
    repeats = row[1:][again & (words[1:] == words[:-1])]
    terms = np.concatenate([words, mixed(shapes ^ np.uint64(0x5851F42D4C957F2D)), pairs]) % np.uint64(DIMENSIONS - 1)
    rows = np.concatenate([row, row, row[1:][again], repeats])
    terms = np.concatenate([terms.astype(np.int64), np.full(len(repeats), DIMENSIONS - 1)])
    return np.bincount(rows * DIMENSIONS + terms, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)


def counted(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, counts) of blocks of texts; a text that came in several pieces has one row."""
    data, offsets = buffers(texts)
    held: tuple[int, np.ndarray] | None = None
    for at, block, cuts in pieces(data, offsets, BLOCK_BYTES):
        counts = term_counts(block, cuts)
        if held and held[0] == at and len(counts) == 1:
            held = (at, held[1] + counts)
            continue
        if held:
            yield held
        held = (at, counts)
    if held:
        yield held


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per partition: its texts, and in how many of them each term stands."""
    seen, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for _, counts in counted(batch.column(0)):
            seen += (counts > 0).sum(axis=0)
            n += len(counts)
    places = np.concatenate([np.flatnonzero(seen), [DIMENSIONS]])
    yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(np.append(seen, n)[places], pa.int64())], names=["term", "n"])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents with each hashed term, documents), over the whole corpus; DIMENSIONS + 1 numbers come back."""
    rows = docs.select(text_of().alias("text")).mapInArrow(_frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(DIMENSIONS + 1, np.int64)
    for r in rows.collect():
        out[r["term"]] = r["n"]
    return out[:-1], int(out[-1])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[bytes, bytes]] = []
        for _, counts in counted(batch.column(1)):
            for row in counts:
                at = np.flatnonzero(row)
                out.append((at.astype("<u2").tobytes(), row[at].astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o[0] for o in out], pa.binary()),
                                          pa.array([o[1] for o in out], pa.binary())], names=["label", "terms", "counts"])


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(label, text) of the documents of at most ``limit`` labelled ids."""
    picked = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("l_id"))
              .agg(F.max("quality").cast("int").alias("label")).orderBy(F.xxhash64("l_id"), "l_id").limit(limit))
    texts = docs.select(F.col("doc_id").alias("d_id"), text_of().alias("text"))
    # rows repeated by a re-delivered table count once; only the sample's texts are shuffled for that
    return texts.join(F.broadcast(picked), F.col("d_id") == F.col("l_id")).groupBy("d_id", "label", "text").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Space:
    """Weights and axes of the terms, and the labelled documents in the latent space (unit vectors)."""

    weights: np.ndarray     # (DIMENSIONS,)
    axes: np.ndarray        # (DIMENSIONS, rank)
    vectors: np.ndarray     # (labelled, rank)
    labels: np.ndarray      # (labelled,)

    def project(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors of term counts; of counts without a known term, zeros."""
        out = (np.log1p(counts.astype(np.float32)) * self.weights) @ self.axes
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, size, out=np.zeros_like(out), where=size > 1e-6)

    def vote(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(vectors), prior)
        # cosines in steps of 1e-5, so that equal texts tie whatever block they stand in
        near = np.round(np.maximum(vectors @ self.vectors.T, 0), 5)
        k = min(neighbours, near.shape[1])
        least = np.partition(near, -k, axis=1)[:, -k][:, None]
        votes = np.where(near >= least, near, 0).astype(np.float64) ** SHARPNESS
        total = votes.sum(axis=1)
        return np.divide(votes @ self.labels, total, out=np.full(len(vectors), prior), where=total > 0)


def latent_axes(rows: np.ndarray, rank: int = RANK, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors, scaled by nothing, by subspace iteration from a fixed start."""
    rank = min(rank, *rows.shape)
    start = np.random.default_rng(7).standard_normal((rows.shape[1], min(rank + 16, min(rows.shape)))).astype(np.float32)
    basis = np.linalg.qr(rows.T @ (rows @ start))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    small = rows @ basis
    return basis @ np.linalg.svd(small, full_matrices=False)[2].T[:, :rank]


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Space:
    """The latent space of the labelled sample; term weights come from all of ``docs``."""
    seen, n = document_frequencies(docs)
    weights = np.log((n + 1) / (seen + 1)).astype(np.float32) + np.float32(0.1)
    rows = labelled_sample(docs, labels, limit).select("label", "text").mapInArrow(
        _sparse, "label int, terms binary, counts binary")
    # bounded: the sample's rows; in an order of their own, so that reruns agree
    held = sorted((bytes(r["terms"]), bytes(r["counts"]), r["label"]) for r in rows.collect())
    if not held:
        return Space(weights, np.zeros((DIMENSIONS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    matrix = np.zeros((len(held), DIMENSIONS), np.float32)
    for i, (terms, counts, _) in enumerate(held):
        at = np.frombuffer(terms, "<u2")
        matrix[i, at] = np.log1p(np.frombuffer(counts, "<u4")) * weights[at]
    size = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix /= np.maximum(size, 1e-6)
    axes = latent_axes(matrix)
    vectors = matrix @ axes
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 1e-6)
    return Space(weights, axes, vectors, np.array([h[2] for h in held], float))


def scored(docs: DataFrame, space: Space, ids: list[str]) -> DataFrame:
    """``ids`` and score of every document."""
    held = docs.sparkSession.sparkContext.broadcast(space)     # bounded by the sample and the rank

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.vote(held.value.project(counts)) for _, counts in counted(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.round(np.concatenate(found), 6) if found else [], pa.float64())],
                names=[*batch.schema.names[:-1], "score"])

    rows = docs.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(ids)], text_of().alias("text"))
    schema = ", ".join([*[f"k_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(ids)], "score double"])
    out = rows.mapInArrow(score, schema)
    return out.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(ids)], "score")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(doc_id.cast("string")) % 3


def op11_latent_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; the rows with remainder 1 are held out of the labels."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    space = fit(docs, labels.where(remainder(F.col("doc_id")) != 1))
    out = scored(docs, space, ["doc_id"])
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
