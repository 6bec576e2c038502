"""Toxicity by a classifier chain.

Categories are predicted one after the other; each linear model sees the
words, and the beginnings of words, that count for its category, and the
probabilities of all earlier categories.  In training those probabilities are
out of fold, so a later model learns from what it will see when scoring.

Labels: ``toxic`` is the last category of the chain.  The earlier ones are
weakly labelled: toxic documents with a seed word of the category.  Models are
fitted with numpy on at most ``MAX_LABELLED`` labelled rows (those with the
smallest hash of their id); all documents are scored, by whole text, in one
narrow pass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import load, put_back, set_apart, text_of
from churnlake.session import checkpoint

# seed words of the weakly labelled categories
SEEDS = {
    "insult": ("idiot", "moron", "clown", "loser", "stupid"),
    "contempt": ("trash", "scum", "worthless", "pathetic", "disgusting"),
}
CATEGORIES = (*SEEDS, "toxic")
MAX_LABELLED = 12_000   # labelled rows that a model may be fitted on
MAX_FEATURES = 200      # features a category's model may use
MIN_ROWS = 3            # labelled rows of the category a feature must occur in
PREFIXES = (4, 5)       # bytes of the beginnings of words
FOLDS = 3
THRESHOLD = 0.5
_BREAKS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def features(text: str) -> set[bytes]:
    """Distinct words (A-Z lower-cased) and their beginnings, marked by their length."""
    words = set(text.encode("utf-8", "surrogatepass").lower().translate(_BREAKS).split())
    return words.union(*[{b"%d:" % n + w[:n] for w in words if len(w) > n} for n in PREFIXES])


@dataclass
class Chain:
    """One linear model per category: bias, weights of its features, weights of the earlier categories."""

    models: dict[str, tuple[float, dict[bytes, float], list[float]]] = field(default_factory=dict)

    def score(self, text: str) -> list[float]:
        seen = features(text)
        out: list[float] = []
        for bias, weights, before in self.models.values():
            z = bias + sum(weights[f] for f in seen & weights.keys()) + sum(w * p for w, p in zip(before, out))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, count: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Ridge logistic regression by Newton steps on rows with counts; the last column's weight is not penalised."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (count * (p - y)) + ridge * w
        hess = (x * (count * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def _features_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: sorted(features(t)))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """Rows (doc_id, toxic, fold, features) of at most ``limit`` labelled documents with texts."""
    picked = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("l_id"))
              .agg(F.max("toxic").cast("int").alias("l_toxic")).orderBy(F.xxhash64("l_id"), "l_id").limit(limit))
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("l_id"))
    return rows.select("doc_id", F.col("l_toxic").alias("toxic"), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"),
                       F.pandas_udf(_features_of, "array<binary>")("text").alias("features"))


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Chain:
    """The fitted chain; without toxic labels it scores everything near 0."""
    sample = labelled_sample(docs, labels, limit)
    for name, words in SEEDS.items():
        seeds = F.array(*[F.lit(w).cast("binary") for w in words])
        sample = sample.withColumn(name, ((F.col("toxic") == 1) & F.arrays_overlap("features", seeds)).cast("int"))
    sample = checkpoint(sample)
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in CATEGORIES]).first()
    counts = checkpoint(sample.select(F.explode("features").alias("f"), *CATEGORIES).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in CATEGORIES]).where(F.col("toxic") >= MIN_ROWS))
    chosen: dict[str, list[bytes]] = {}
    for c in CATEGORIES:
        yes, no = totals[c] or 0, (totals["n"] or 0) - (totals[c] or 0)
        gain = F.col(c) * F.log(((F.col(c) + 0.5) / (yes + 1.0)) / ((F.col("n") - F.col(c) + 0.5) / (no + 1.0)))
        top = counts.where(F.col(c) >= MIN_ROWS).withColumn("gain", gain).where("gain > 0")
        chosen[c] = [bytes(r["f"]) for r in top.orderBy(F.desc("gain"), "f").limit(MAX_FEATURES).collect()]
    known = sorted({f for fs in chosen.values() for f in fs})
    place = {f: i for i, f in enumerate(known)}
    literal = F.array(*[F.lit(f) for f in known]).cast("array<binary>")
    # bounded: at most ``limit`` rows of at most the chosen features
    seen = Counter((r["fold"], tuple(r[c] for c in CATEGORIES), tuple(sorted(place[bytes(f)] for f in r["has"])))
                   for r in sample.select("fold", *CATEGORIES, F.array_intersect("features", literal).alias("has")).collect())
    rows = sorted(seen)     # equal rows once, with their count
    count = np.array([seen[r] for r in rows], float)
    x = np.zeros((len(rows), len(known)))
    for i, (_, _, has) in enumerate(rows):
        x[i, list(has)] = 1.0
    fold = np.array([r[0] for r in rows], int)
    chain, before = Chain(), np.zeros((len(rows), 0))
    for i, c in enumerate(CATEGORIES):
        y = np.array([r[1][i] for r in rows], float)
        own = np.column_stack([x[:, [place[f] for f in chosen[c]]], before, np.ones(len(rows))])
        if not len(rows) or not y.any():
            chain.models[c] = (-10.0, {}, [0.0] * before.shape[1])
            before = np.column_stack([before, np.full(len(rows), 1 / (1 + np.exp(10)))])
            continue
        w = fit_logistic(own, y, count)
        n = len(chosen[c])
        chain.models[c] = (float(w[-1]), dict(zip(chosen[c], map(float, w[:n]))), [float(v) for v in w[n:-1]])
        out_of_fold = _probability(own, w)
        for k in range(FOLDS):
            if (fold == k).any() and y[fold != k].any():
                out_of_fold[fold == k] = _probability(own[fold == k], fit_logistic(own[fold != k], y[fold != k], count[fold != k]))
        before = np.column_stack([before, out_of_fold])
    return chain


def scorer(chain: Chain):
    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(chain.score)

    return score


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose last probability reaches the threshold.

    Null and empty texts have no words and stay; a text of any length is scored as a whole; each of repeated rows has
    the same verdict; a document with several labels counts as toxic if one says so; an empty table gives no rows;
    extra columns of any name pass through.
    """
    score = scorer(train(docs, labels))
    plain, at = set_apart(docs)
    return put_back(plain.withColumn("p", score(text_of(at["text"]))).where(F.element_at("p", -1) < threshold), at)


def op8_classifier_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities and verdict for all documents."""
    docs = load(spark, sf_dir, "documents")
    score = scorer(train(docs, load(spark, sf_dir, "labels")))
    out = docs.select("doc_id", score(text_of()).alias("p"))
    return out.select("doc_id", *[F.round(F.get("p", F.lit(i)), 6).alias(f"p_{c}") for i, c in enumerate(CATEGORIES)],
                      (F.element_at("p", -1) >= THRESHOLD).alias("rejected"))
