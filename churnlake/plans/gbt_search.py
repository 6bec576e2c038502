"""Boosted trees of all points of a search, fitted together on the same rows.

The trees are those of Spark's GBTClassifier: log loss on labels -1 and 1, the
first tree on the labels with weight 1, each later one on the residuals with
the learning rate; variance gain over at most ``MAX_BINS`` bins a column, with
Spark's rule for the bin borders; a drawn share of the rows for each tree and of
the columns for each node.  What differs: draws are hashes of the row's number,
the tree and the node, and residuals are whole multiples of 1 / ``SCALE``, so
that sums do not depend on how the rows lie; and the borders come from all rows
(Spark: from 10,000 drawn ones).

Rows are read as bin numbers, two bytes a value.  A table of at most
``FEW_ROWS`` rows goes to every task and a task fits one model.  A larger one
stays in blocks: each pass adds up the sums of the next level of every model's
tree, one shuffle keyed by model adds up the tasks and finds the splits, and the
driver holds the trees of one round.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators.ranking import running_sums
from churnlake.session import ensure_checkpoint_dir, shared_path, stored

MAX_BINS = 32
CELLS = 10_000          # of equal numbers of rows, per column, from which bin borders are taken
SCALE = float(1 << 24)  # sums are exact up to 2**27 rows
FEW_ROWS = 300_000      # a task holds about 250 bytes a row
CHUNK = 8192            # rows of one sum: its keys stay in the cache
KEPT_ROUNDS = 20        # rounds between two checkpoints of the margins
SEED = 42


class Fit(NamedTuple):
    depth: int
    rate: float
    gain: float             # least gain of a split
    least: int              # rows of a node
    rows: float             # share drawn for a tree
    columns: float          # share drawn for a node
    sizes: dict[int, int]   # place of a search point -> its number of trees


class Rows(NamedTuple):
    code: np.ndarray        # per row and column: the column's first code plus the value's bin
    rare: np.ndarray        # the row's codes that are not their column's usual one, filled up with the number of codes
    label: np.ndarray
    number: np.ndarray
    inside: np.ndarray      # rows to fit on; the others are scored


class Codes(NamedTuple):
    borders: list[np.ndarray]   # per column: a value up to border b is in bin b
    first: np.ndarray           # first code of each column, and the number of codes
    usual: np.ndarray           # most frequent code of each column: its sums are what the others leave of a node's

    @property
    def width(self) -> int:
        return int(self.first[-1])

    @property
    def type(self) -> np.dtype:
        return np.min_scalar_type(self.width)


class Splits(NamedTuple):
    """Per open node: totals, the best split (column -1: none) and its left side."""

    n: np.ndarray
    total: np.ndarray
    column: np.ndarray
    cut: np.ndarray
    left_n: np.ndarray
    left: np.ndarray


class Tree:
    """Nodes as in a heap: the children of i are 2i + 1 and 2i + 2."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.column, self.cut, self.value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        self.depth, self.level, self.open = depth, 0, np.array([0])

    def grow(self, found: Splits, least: int) -> None:
        """Splits the open nodes and opens those children that may split in turn."""
        if self.level == 0 and found.n[0]:
            self.value[0] = found.total[0] / found.n[0] / SCALE
        at = np.flatnonzero(found.column >= 0)
        node, n = self.open[at], np.column_stack([found.left_n, found.n - found.left_n])[at]
        side = np.column_stack([found.left, found.total - found.left])[at]
        self.column[node], self.cut[node] = found.column[at], found.cut[at]
        children = 2 * node[:, None] + [1, 2]
        self.value[children] = side / n / SCALE
        self.level += 1
        self.open = children[n >= max(2 * least, 2)] if self.level < self.depth else children[:0].ravel()

    def move(self, code: np.ndarray, node: np.ndarray) -> None:
        """Takes the rows' nodes one level further down, in place, where their node is split."""
        column = self.column[node]
        at = np.flatnonzero(column >= 0)
        here = node[at]
        node[at] = 2 * here + 1 + (code[at, column[at]] > self.cut[here])

    def nodes(self, code: np.ndarray) -> np.ndarray:
        node = np.zeros(len(code), np.int64)
        for _ in range(self.level):
            self.move(code, node)
        return node


def fits_of(points: list[dict]) -> list[Fit]:
    """One fit for points that differ only in their number of trees: boosting adds one tree after the other."""
    groups: dict[tuple, dict[int, int]] = {}
    for i, p in enumerate(points):
        key = (p["max_depth"], float(p["learning_rate"]), float(p["gamma"]), int(p["min_child_weight"]),
               float(p["subsample"]), float(p["colsample_bytree"]))
        groups.setdefault(key, {})[i] = p["n_estimators"]
    return [Fit(*key, sizes) for key, sizes in groups.items()]


# ---- draws ---------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """Hash of 64-bit numbers (the last steps of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keyed(tree: int, x: np.ndarray) -> np.ndarray:
    key = _mixed(np.array([SEED * 1_000_003 + tree], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _mixed(x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + key)


def drawn_rows(number: np.ndarray, tree: int, share: float) -> np.ndarray:
    if share >= 1:
        return np.ones(len(number), bool)
    return (_keyed(tree, number) >> np.uint64(11)).astype(float) < share * 2.0 ** 53


def drawn_columns(node: np.ndarray, tree: int, share: float, columns: int) -> np.ndarray:
    """(nodes, columns): the same number of columns for every node."""
    some = int(np.ceil(share * columns))
    if some >= columns:
        return np.ones((len(node), columns), bool)
    keys = _keyed(tree, ~(node[:, None] * np.int64(columns) + np.arange(columns)))
    out = np.zeros(keys.shape, bool)
    np.put_along_axis(out, np.argsort(keys, axis=1, kind="stable")[:, :max(some, 1)], True, axis=1)
    return out


# ---- one level of one tree -------------------------------------------------------------------------

def weight(fit: Fit, tree: int) -> float:
    return fit.rate if tree else 1.0


def residuals(label: np.ndarray, margin: np.ndarray, tree: int) -> np.ndarray:
    sign = 2 * label - 1
    if tree:
        with np.errstate(over="ignore"):
            sign = 4 * sign / (1 + np.exp(2 * sign * margin))
    return np.rint(sign * SCALE)


def level_sums(rows: Rows, drawn: np.ndarray, node: np.ndarray, target: np.ndarray, nodes: np.ndarray, tree: Tree,
               codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, codes): drawn rows and sums of their target in some of the tree's nodes."""
    place = np.full(len(tree.column), -1)
    place[nodes] = np.arange(len(nodes))
    at = place[node]
    on = np.flatnonzero((at >= 0) & drawn)
    wide = codes.width + 1
    size = len(nodes) * wide
    n, total = np.zeros(size), np.zeros(size)
    for i in range(0, len(on), CHUNK):
        part = on[i:i + CHUNK]
        keys = (rows.rare[part] + (at[part] * wide)[:, None]).ravel()
        n += np.bincount(keys, minlength=size)
        total += np.bincount(keys, np.repeat(target[part], rows.rare.shape[1]), size)

    def filled(sums: np.ndarray, all_: np.ndarray) -> np.ndarray:
        sums = sums.reshape(-1, wide)[:, :-1]
        sums[:, codes.usual] = all_[:, None] - np.add.reduceat(sums, codes.first[:-1], axis=1)
        return sums

    return (filled(n, np.bincount(at[on], minlength=len(nodes))),
            filled(total, np.bincount(at[on], target[on], len(nodes))))


def open_sums(rows: Rows, drawn: np.ndarray, node: np.ndarray, target: np.ndarray, parents: np.ndarray, found: Splits,
              before: tuple[np.ndarray, np.ndarray], tree: Tree, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """``level_sums`` of the open nodes from those ``before`` of their parents: only the smaller child is added up."""
    parent = (tree.open - 1) // 2
    some, of = np.unique(parent, return_inverse=True)
    at = np.searchsorted(parents, some)
    small = 2 * some + 1 + (2 * found.left_n[at] > found.n[at])
    other = (tree.open != small[of])[:, None]
    return tuple(np.where(other, b[at[of]] - s[of], s[of])
                 for b, s in zip(before, level_sums(rows, drawn, node, target, small, tree, codes)))


def best_splits(n: np.ndarray, total: np.ndarray, open_: np.ndarray, fit: Fit, tree: int, codes: Codes) -> Splits:
    """The split of the largest gain of every open node; of equal ones the first."""
    first = codes.first
    start = np.repeat(first[:-1], np.diff(first))
    of_column = np.repeat(np.arange(len(first) - 1), np.diff(first))

    def left_of(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.concatenate([np.zeros((len(sums), 1)), np.cumsum(sums, axis=1)], axis=1)
        return run[:, 1:] - run[:, start], run[:, first[1]]

    (left_n, all_n), (left, all_) = left_of(n), left_of(total)
    right_n, right = all_n[:, None] - left_n, all_[:, None] - left
    may = (left_n >= fit.least) & (right_n >= fit.least) & (left_n > 0) & (right_n > 0)
    may &= drawn_columns(open_, tree, fit.columns, len(first) - 1)[:, of_column]
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = (left * right_n - right * left_n) / SCALE / all_n[:, None]
        gain = np.where(may, apart * apart / (left_n * right_n), -1.0)
    best, each = np.argmax(gain, axis=1), np.arange(len(gain))
    good = (gain[each, best] > 0) & (gain[each, best] >= fit.gain)
    return Splits(all_n, all_, np.where(good, of_column[best], -1), best, left_n[each, best], left[each, best])


# ---- rows --------------------------------------------------------------------------------------------

def row_table(inside: DataFrame, outside: DataFrame) -> DataFrame:
    """(inside, label, number, x) of both, written once.  Without a column ``number`` equal rows are drawn together."""
    def plain(df: DataFrame, fitted: bool) -> DataFrame:
        x, y = vector_to_array(F.col("features")), F.col("label").cast("double")
        if fitted:
            y = F.when(y.isin(0.0, 1.0), y).otherwise(F.raise_error(F.lit("labels must be 0 or 1")).cast("double"))
        number = F.col("number") if "number" in df.columns else F.xxhash64("label", x)
        return df.select(F.lit(fitted).alias("inside"), y.alias("label"), number.alias("number"), x.alias("x"))

    return stored(plain(inside, True).unionByName(plain(outside, False)), "gbt_rows")


def column_borders(values: list[float], counts: list[int], bins: int) -> np.ndarray:
    """Spark's bin borders of a column from its values in order: between all neighbours if they are few, else where
    the running count is nearest to the next multiple of an equal share."""
    if not values:
        return np.array([])
    middles = [(a + b) / 2 for a, b in zip(values, values[1:])]
    if len(middles) < bins:
        return np.array(middles)
    stride = sum(counts) / bins
    out, run, target = [], counts[0], stride
    for middle, n in zip(middles, counts[1:]):
        if abs(run - target) < abs(run + n - target):
            out.append(middle)
            target += stride
        run += n
    return np.array(out)


def codes_of(rows: DataFrame) -> Codes:
    """Bin borders of every column, from the values of all rows to fit on: exact for up to ``CELLS`` rows, beyond
    that from cells of equal numbers of rows."""
    width = rows.select(F.size("x")).first()
    values = rows.where("inside").select(F.posexplode("x").alias("at", "value")).where(~F.isnan("value"))
    counts = stored(values.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")), "gbt_values")
    totals = counts.groupBy("at").agg(F.sum("n").alias("total"))
    cell = F.expr(f"(cum_n - 1) * {CELLS} div total")
    cells = (running_sums(counts, ["at"], ["value"], ["n"]).join(F.broadcast(totals), "at")
             .groupBy("at", cell.alias("cell")).agg(F.max("value").alias("value"), F.sum("n").alias("n")))
    found: dict[int, list[tuple[float, int]]] = {}
    for r in cells.orderBy("at", "value").collect():
        found.setdefault(r["at"], []).append((r["value"], r["n"]))
    borders, usual = [], []
    for j in range(width[0] if width else 0):
        values, n = [v for v, _ in found.get(j, [])], [n for _, n in found.get(j, [])]
        borders.append(column_borders(values, n, min(MAX_BINS, sum(n))))
        usual.append(np.argmax(np.bincount(np.searchsorted(borders[j], values), n, len(borders[j]) + 1)))
    first = np.concatenate([[0], np.cumsum([len(b) + 1 for b in borders])]).astype(int)
    return Codes(borders, first, first[:-1] + np.array(usual, int))


_BLOCK = "code binary, label binary, number binary, inside binary"


def _coded(codes: Codes):
    """A batch of rows as one row of packed columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            inside, label, number, x = batch.columns
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            code = np.column_stack([np.searchsorted(b, x[:, j]) + codes.first[j] for j, b in enumerate(codes.borders)])
            packed = [code.astype(codes.type), label.to_numpy(zero_copy_only=False).astype(float),
                      number.to_numpy(zero_copy_only=False).astype(np.int64),
                      inside.to_numpy(zero_copy_only=False).astype(bool)]
            yield pa.RecordBatch.from_pydict({n: pa.array([v.tobytes()], pa.binary())
                                              for n, v in zip(("code", "label", "number", "inside"), packed)})

    return run


def rows_of(blocks: list, codes: Codes) -> Rows:
    """The rows of some packed blocks."""
    code, label, number, inside = [np.concatenate([np.frombuffer(b[c], t) for b in blocks]) for c, t in (
        ("code", codes.type), ("label", float), ("number", np.int64), ("inside", bool))]
    code = code.reshape(len(label), -1)
    usual = code == codes.usual
    most = int((~usual).sum(axis=1).max(initial=1))
    rare = np.where(usual, codes.width, code).astype(codes.type)
    return Rows(code, np.sort(rare, axis=1)[:, :most], label, number, inside)


# ---- few rows: a model a task --------------------------------------------------------------------------

def grown(rows: Rows, fit: Fit, codes: Codes) -> Iterator[tuple[Tree, np.ndarray]]:
    """The trees one after the other, each with the margins of all rows after it."""
    margin = np.zeros(len(rows.label))
    for t in range(max(fit.sizes.values())):
        drawn, target = rows.inside & drawn_rows(rows.number, t, fit.rows), residuals(rows.label, margin, t)
        tree, node = Tree(fit.depth), np.zeros(len(margin), np.int64)
        sums = level_sums(rows, drawn, node, target, tree.open, tree, codes)
        while True:
            parents, found = tree.open, best_splits(*sums, tree.open, fit, t, codes)
            tree.grow(found, fit.least)
            tree.move(rows.code, node)
            if not len(tree.open):
                break
            sums = open_sums(rows, drawn, node, target, parents, found, sums, tree, codes)
        margin = margin + weight(fit, t) * tree.value[node]
        yield tree, margin


def fit_alone(rows: Rows, fit: Fit, codes: Codes) -> Iterator[tuple[int, np.ndarray]]:
    """(place of a point, margins of the rows outside) as the trees of each point are complete."""
    for t, (_, margin) in enumerate(grown(rows, fit, codes)):
        for i, n in fit.sizes.items():
            if n == t + 1:
                yield i, margin[~rows.inside]


def _scores_alone(blocks: DataFrame, fits: list[Fit], codes: Codes) -> DataFrame:
    spark = blocks.sparkSession
    rows = spark.sparkContext.broadcast(rows_of(blocks.collect(), codes))
    fits = sorted(fits, key=lambda f: -max(f.sizes.values()) * 2 ** f.depth)    # the longest begin first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                label = rows.value.label[~rows.value.inside]
                for i, margin in fit_alone(rows.value, fits[k], codes):
                    yield pa.RecordBatch.from_pydict({"point": pa.array(np.full(len(label), i), pa.int32()),
                                                      "label": pa.array(label, from_pandas=True), "score": pa.array(margin)})

    scored = spark.range(0, len(fits), 1, len(fits)).mapInArrow(run, "point int, label double, score double")
    return stored(scored, "gbt_scores")


# ---- many rows: all models a pass ------------------------------------------------------------------------

def _added(a, b):
    return a[0] + b[0], a[1] + b[1]


def _block_sums(growing, fits: list[Fit], t: int, codes: Codes):
    """Per task: (model, its sums for the open nodes)."""
    def run(blocks) -> Iterator[tuple]:
        sums: dict[int, tuple] = {}
        for rows, margin, _ in blocks:
            drawn = {share: rows.inside & drawn_rows(rows.number, t, share)
                     for share in {fits[m].rows for m in growing.value}}
            for m, tree in growing.value.items():
                found = level_sums(rows, drawn[fits[m].rows], tree.nodes(rows.code), residuals(rows.label, margin[:, m], t),
                                   tree.open, tree, codes)
                sums[m] = _added(sums[m], found) if m in sums else found
        yield from sums.items()

    return run


def _advanced(trees, fits: list[Fit], t: int):
    """Adds the round's trees to the margins, and keeps those of points that have all their trees."""
    def run(block):
        rows, margin, kept = block
        margin, kept = margin.copy(), dict(kept)
        for m, tree in trees.value.items():
            margin[:, m] += weight(fits[m], t) * tree.value[tree.nodes(rows.code)]
            for i, n in fits[m].sizes.items():
                if n == t + 1:
                    kept[i] = margin[~rows.inside, m]
        return rows, margin, kept

    return run


def _by_passes(blocks: DataFrame, fits: list[Fit], codes: Codes) -> tuple[DataFrame, list[dict[int, Tree]]]:
    """Scores, and the trees of every round by model."""
    spark = blocks.sparkSession
    sc, many = spark.sparkContext, len(fits)
    ensure_checkpoint_dir(spark)
    state: RDD = blocks.rdd.map(lambda r: (rows := rows_of([r], codes), np.zeros((len(rows.label), many)), {}))
    state.persist(StorageLevel.MEMORY_AND_DISK)
    old_file, rounds = None, []
    for t in range(max(n for f in fits for n in f.sizes.values())):
        trees = {m: Tree(f.depth) for m, f in enumerate(fits) if max(f.sizes.values()) > t}
        growing = trees
        while growing:
            sent = sc.broadcast(growing)
            found = dict(state.mapPartitions(_block_sums(sent, fits, t, codes))
                         .reduceByKey(_added, min(len(growing), sc.defaultParallelism))
                         .map(lambda s, sent=sent, t=t: (s[0], best_splits(*s[1], sent.value[s[0]].open, fits[s[0]], t, codes)))
                         .collect())
            for m, splits in found.items():
                growing[m].grow(splits, fits[m].least)
            growing = {m: growing[m] for m in found if len(growing[m].open)}
            sent.destroy()
        rounds.append(trees)
        sent = sc.broadcast(trees)
        before, state = state, state.map(_advanced(sent, fits, t)).persist(StorageLevel.MEMORY_AND_DISK)
        kept = t % KEPT_ROUNDS == KEPT_ROUNDS - 1
        if kept:
            state.checkpoint()
        state.count()
        before.unpersist()
        if kept:
            _removed(sc, old_file)
            old_file = state.getCheckpointFile()

    def scores(block) -> list[tuple]:
        rows, _, kept = block
        label = [None if np.isnan(y) else y for y in rows.label[~rows.inside].tolist()]
        return [(i, label, margin.tolist()) for i, margin in kept.items()]

    packed = spark.createDataFrame(state.flatMap(scores), "point int, label array<double>, score array<double>")
    out = stored(packed.select("point", F.explode(F.arrays_zip("label", "score")).alias("r"))
                 .select("point", "r.label", "r.score"), "gbt_scores")
    state.unpersist()
    _removed(sc, old_file)
    return out, rounds


def _removed(sc, file: str | None) -> None:
    """Deletes a checkpoint that later ones replace."""
    if file:
        path = sc._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


# ---- the search's parts ------------------------------------------------------------------------------------

def _prepared(rows: DataFrame) -> tuple[DataFrame, Codes, bool]:
    codes = codes_of(rows)
    return rows.mapInArrow(_coded(codes), _BLOCK), codes, rows.count() <= FEW_ROWS


def scores(inside: DataFrame, outside: DataFrame, points: list[dict]) -> DataFrame:
    """(point, label, score): margins of the rows of ``outside`` under each point's model of ``inside``."""
    blocks, codes, few = _prepared(row_table(inside, outside))
    return _scores_alone(blocks, fits_of(points), codes) if few else _by_passes(blocks, fits_of(points), codes)[0]


class PointFit(Estimator):
    """The fit of one point on all rows, as the search does it: a Spark model to score with and save."""

    def __init__(self, point: dict):
        super().__init__()
        self.point = point

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        blocks, codes, few = _prepared(row_table(dataset, dataset.limit(0)))
        fit, sc = fits_of([self.point])[0], dataset.sparkSession.sparkContext
        if few:
            rows = sc.broadcast(rows_of(blocks.collect(), codes))
            trees = sc.parallelize([0], 1).map(lambda _: [tree for tree, _ in grown(rows.value, fit, codes)]).first()
        else:
            trees = [r[0] for r in _by_passes(blocks, [fit], codes)[1]]
        return as_model(dataset.sparkSession, trees, _node_sums(blocks, trees, fit, codes), fit, codes)


def _node_sums(blocks: DataFrame, trees: list[Tree], fit: Fit, codes: Codes) -> np.ndarray:
    """(trees, nodes, 3): drawn rows, sum and sum of squares of what each tree was fitted to, in one pass."""
    sent = blocks.sparkSession.sparkContext.broadcast(trees)

    def run(packed) -> Iterator[np.ndarray]:
        out = np.zeros((len(sent.value), len(sent.value[0].value), 3))
        for block in packed:
            rows = rows_of([block], codes)
            margin = np.zeros(len(rows.label))
            for t, tree in enumerate(sent.value):
                node = tree.nodes(rows.code)
                drawn = rows.inside & drawn_rows(rows.number, t, fit.rows)
                at, target = node[drawn], residuals(rows.label, margin, t)[drawn] / SCALE
                for j, v in enumerate((None, target, target * target)):
                    out[t, :, j] += np.bincount(at, v, out.shape[1])
                margin += weight(fit, t) * tree.value[node]
        yield out

    sums = blocks.rdd.mapPartitions(run).reduce(lambda a, b: a + b)
    for node in range(sums.shape[1] // 2 - 1, -1, -1):
        sums[:, node] += sums[:, 2 * node + 1] + sums[:, 2 * node + 2]
    return sums


def _node_rows(trees: list[Tree], sums: np.ndarray, codes: Codes) -> Iterator[tuple]:
    """Rows of a saved model: a node comes before its left side, that before its right one."""
    for t, (tree, s) in enumerate(zip(trees, sums)):
        n = s[:, 0]
        spread = np.maximum(s[:, 2] - s[:, 1] ** 2 / np.maximum(n, 1), 0) / np.maximum(n, 1)
        order, todo = [], [0]
        while todo:
            i = todo.pop()
            order.append(i)
            if tree.column[i] >= 0:
                todo += [2 * i + 2, 2 * i + 1]
        at = {i: k for k, i in enumerate(order)}
        for i in order:
            j, a, b = int(tree.column[i]), 2 * i + 1, 2 * i + 2
            gain, sides, split = -1.0, (-1, -1), (-1, [], -1)
            if j >= 0:
                gain = float(spread[i] - (n[a] * spread[a] + n[b] * spread[b]) / n[i])
                sides, split = (at[a], at[b]), (j, [float(codes.borders[j][tree.cut[i] - codes.first[j]])], -1)
            yield t, (at[i], float(tree.value[i]), float(spread[i]), s[i].tolist(), int(n[i]), gain, *sides, split)


def as_model(spark: SparkSession, trees: list[Tree], sums: np.ndarray, fit: Fit, codes: Codes) -> GBTClassificationModel:
    """Fitted trees as a Spark ML model, for scoring and saving.  A model of single nodes is saved, its nodes are
    written anew and it is loaded: handed over one by one, 19,200 nodes took 31 s."""
    sc, width = spark.sparkContext, len(codes.borders)
    jvm, gateway = sc._jvm, sc._gateway
    ml = jvm.org.apache.spark.ml
    stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0)
    leaf, of_root = ml.tree.LeafNode(0.0, 0.0, stats), ml.regression.DecisionTreeRegressionModel
    made, weights = gateway.new_array(of_root, len(trees)), gateway.new_array(jvm.double, len(trees))
    for t in range(len(trees)):
        made[t], weights[t] = of_root(leaf, width), weight(fit, t)
    path = shared_path(spark, "gbt_model")
    GBTClassificationModel(ml.classification.GBTClassificationModel("gbt_batch", made, weights, width, 2)).write().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame(list(_node_rows(trees, sums, codes)), schema).write.mode("overwrite").parquet(f"{path}/data")
    return GBTClassificationModel.load(path).setFeaturesCol("features")
