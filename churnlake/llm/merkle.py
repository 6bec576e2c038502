"""Merkle manifest of a dataset, with proofs found by pointer jumping.

Every row is a leaf; per group (a column) the leaves stand in order, and runs
of ``FANOUT`` consecutive nodes become their parent until one is left, the
group's subroot; the subroots are the leaves of a top tree, whose last node is
the root.  A node's segment towards an ancestor is the list of sibling digests
on the way: per level those left and those right of it.  At first every inner
node holds the segment towards its parent.  In each round a node joins the
node its segment ends at and appends that one's segment, so the distance
doubles, and a tree of height h takes log2(h) rounds.  Leaves are seven of
eight nodes, so they jump once, at last, over their parent's whole segment.

Defined results: a null value counts as ``-``; a null group is a group of its
own, before all others; leaves ascend by the order column, null first, and
rows that agree in it by their digest, so equal rows are leaves of their own
with one digest and the tree does not depend on how rows are read; texts of
any length are hashed whole by their task; an empty table has no leaves and no
root; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import ascii_lower, broadcast_if_small, load, range_index
from churnlake.session import checkpoint

FANOUT = 8
TOGETHER = 1 << 16     # nodes of an upper level that one task may hold
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "top"         # tree of the subroots; the trees of groups are "=" and the group, or "null"
_NODE = ("tree", "level", "idx")


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value (integers decimal)."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def parents_of(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, idx, n, hash, kids) of the next level; n is the number of its tree's nodes, kids are the children in
    order as (idx, hash, c_tree, c_level, c_idx).  Trees of one node have no next level."""
    runs = level.where("n > 1").groupBy("tree", F.expr(f"idx div {fanout}").alias("p_idx"), "n").agg(
        F.array_sort(F.collect_list(F.struct("idx", "hash", "c_tree", "c_level", "c_idx"))).alias("kids"))
    hashes = F.array_join(F.transform("kids", lambda k: _hex(k["hash"])), "")
    return runs.select("tree", F.col("p_idx").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                       F.unhex(F.sha2(hashes, 256)).alias("hash"), "kids")


def _narrowed(level: DataFrame, rows: int) -> DataFrame:
    """Few partitions for few rows: the upper levels shrink to an eighth each."""
    return level.coalesce(1 + rows // TOGETHER)


def _climb(leaves: DataFrame) -> list[DataFrame]:
    """All levels above ``leaves``, each written to the shared folder; one job a level, an eighth of the rows each."""
    most, rows, trees = leaves.agg(F.max("n"), F.count(F.lit(1)), F.count_if(F.col("idx") == 0)).first()
    levels, now, height = [], leaves, 0
    while (most or 0) > 1:
        height += 1
        rows = rows // FANOUT + trees
        now = checkpoint(_narrowed(parents_of(now), rows).withColumns({
            "c_tree": F.col("tree"), "c_level": F.lit(height), "c_idx": F.col("idx"), "level": F.lit(height)}))
        levels.append(now)
        most = -(-most // FANOUT)
    return levels


def _packed(kids: Column) -> Column:
    """The digests one after the other, as bytes."""
    return F.aggregate(kids, F.lit(b""), lambda a, k: F.concat(a, k["hash"]))


def _segment(kids: Column, at: Column) -> Column:
    """The siblings of the child at place ``at``: (left, right), digests as bytes one after the other."""
    return F.struct(_packed(F.slice(kids, 1, at)).alias("left"),
                    _packed(F.slice(kids, at + 2, F.lit(FANOUT))).alias("right"))


def _links(levels: list[DataFrame], inner_only: bool) -> DataFrame:
    """(tree, level, idx, a_tree, a_level, a_idx, path) of the children of all levels: the segment towards the parent."""
    rows = []
    for level in levels[1:] if inner_only else levels:
        rows.append(level.select(F.col("tree").alias("a_tree"), F.col("level").alias("a_level"), F.col("idx").alias("a_idx"),
                                 "kids", F.posexplode("kids").alias("at", "kid"))
                    .select(F.col("kid.c_tree").alias("tree"), F.col("kid.c_level").alias("level"), F.col("kid.c_idx").alias("idx"),
                            "a_tree", "a_level", "a_idx", F.array(_segment(F.col("kids"), F.col("at"))).alias("path")))
    return reduce(DataFrame.union, rows)


def _jump(links: DataFrame, root: tuple, farthest: int) -> DataFrame:
    """(tree, level, idx, path): every node's whole segment towards the root, ``farthest`` levels up at most.

    Nodes that have reached the root leave the join, so its digest is no hot key.  A node that others of distance
    d point at has d levels of its group's tree below it, or stands in the top tree: the more point at one, the
    fewer they are, and that side is broadcast if its counted size allows.
    """
    there = (F.col("a_tree") == root[0]) & (F.col("a_level") == root[1]) & (F.col("a_idx") == root[2])
    links, distance = checkpoint(links), 1
    while distance < farthest:
        up = links.where((F.col("tree") == TOP) | (F.col("level") > distance)).select(
            *[F.col(c).alias(f"u_{c}") for c in (*_NODE, "a_tree", "a_level", "a_idx", "path")])
        joined = links.where(~there).join(broadcast_if_small(up, distance * (FANOUT * 32 + 64)), [
            F.col("a_tree") == F.col("u_tree"), F.col("a_level") == F.col("u_level"), F.col("a_idx") == F.col("u_idx")])
        farther = joined.select(*_NODE, F.col("u_a_tree").alias("a_tree"), F.col("u_a_level").alias("a_level"),
                                F.col("u_a_idx").alias("a_idx"), F.concat("path", "u_path").alias("path"))
        links = checkpoint(links.where(there).union(farther))
        distance *= 2
    return links.select(*_NODE, "path")


def fold(leaf: Column, path: Column) -> Column:
    """The digest (hex) that a leaf (hex) and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])), 256))


def manifest(rows: DataFrame, group: str, order: str, digest: str = "leaf") -> tuple[DataFrame, str | None]:
    """(proofs, root): ``rows`` with subroot (hex) and path, the segments of sibling digests from the row to the
    root; root is None if there are no rows.  ``rows`` must be narrow and cheap to read twice (a written table);
    its column ``digest`` holds the leaf digests as bytes.  Its columns may have any names."""
    names = rows.columns
    place = {c: f"v_{i}" for i, c in enumerate(names)}
    proofs, root = _proofs(rows.toDF(*place.values()), place[group], place[order], place[digest])
    return proofs.select(*[F.col(v).alias(c) for c, v in place.items()], "subroot", "path"), root


def _proofs(rows: DataFrame, group: str, order: str, digest: str) -> tuple[DataFrame, str | None]:
    keyed = rows.withColumn("tree", F.when(F.col(group).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(group))))
    placed = range_index(keyed, ["tree"], [order, digest], "idx")
    # one small row per group
    sizes = checkpoint(placed.groupBy(F.col("tree").alias("s_tree")).agg(F.count(F.lit(1)).alias("n")))
    leaves = checkpoint(placed.join(broadcast_if_small(sizes, 128), F.col("tree") == F.col("s_tree")).drop("s_tree"))
    nodes = leaves.select("tree", "idx", "n", F.col(digest).alias("hash"), F.col("tree").alias("c_tree"),
                          F.lit(0).alias("c_level"), F.col("idx").alias("c_idx"))
    levels = _climb(nodes)
    subroots = reduce(DataFrame.union, [lv.where("n = 1").select("tree", "hash", "c_tree", "c_level", "c_idx")
                                        for lv in [nodes, *levels]])
    # "null" sorts after "=...", so whether the group is null comes first
    subroots = subroots.select("*", (F.col("tree") != "null").alias("known"))
    n_groups = sizes.count()
    subroots = checkpoint(_narrowed(subroots, n_groups))
    if not n_groups:
        return leaves.select(*rows.columns, F.lit(None).cast("string").alias("subroot"),
                             F.array().cast("array<struct<left:binary,right:binary>>").alias("path")), None
    tops = _narrowed(range_index(subroots, [], ["known", "tree"], "idx"), n_groups).select(
        F.lit(TOP).alias("tree"), "idx", F.lit(n_groups).cast("bigint").alias("n"), "hash", "c_tree", "c_level", "c_idx")
    above = _climb(tops)
    last = above[-1] if above else tops
    end = last.first()
    root = (end["c_tree"], end["c_level"], end["c_idx"])
    # the segments of inner nodes, and of leaves that are subroots; a group's other leaves jump over their parent
    inner = [x for x in [_links(levels, True) if len(levels) > 1 else None, _links(above, False) if above else None] if x is not None]
    empty = F.array().cast("array<struct<left:binary,right:binary>>")
    paths = _jump(reduce(DataFrame.union, inner), root, len(levels) + len(above)) if inner else None
    itself = last.select(F.col("c_tree").alias("tree"), F.col("c_level").alias("level"), F.col("c_idx").alias("idx"), empty.alias("path"))
    paths = itself if paths is None else paths.union(itself)

    done = leaves.join(broadcast_if_small(subroots.select(F.col("tree").alias("r_tree"), F.col("hash").alias("r_hash")), 192),
                       F.col("tree") == F.col("r_tree"))
    lone = done.where("n = 1").join(broadcast_if_small(paths.where((F.col("level") == 0)).select(F.col("tree").alias("p_tree"), "path"), 4096),
                                    F.col("tree") == F.col("p_tree"))
    out = lone.select(*rows.columns, _hex(F.col("r_hash")).alias("subroot"), "path")
    if levels:
        up = levels[0].select("tree", "idx", "kids").join(
            paths.where("level = 1").select(F.col("tree").alias("q_tree"), F.col("idx").alias("q_idx"), "path"),
            [F.col("tree") == F.col("q_tree"), F.col("idx") == F.col("q_idx")])
        up = up.select(F.col("tree").alias("p_tree"), F.col("idx").alias("p_idx"), "kids", "path")
        many = done.where("n > 1").join(up, [F.col("tree") == F.col("p_tree"), F.expr(f"idx div {FANOUT}") == F.col("p_idx")])
        own = F.array(_segment(F.col("kids"), F.expr(f"CAST(idx % {FANOUT} AS INT)")))
        out = many.select(*rows.columns, _hex(F.col("r_hash")).alias("subroot"), F.concat(own, "path").alias("path")).union(out)
    return out, bytes(end["hash"]).hex()


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, held against its text after a third of them were tampered with."""
    docs = load(spark, sf_dir, "documents").select(*FIELDS)
    columns = {c: F.col(c) for c in FIELDS}
    tampered = leaf_digest(list((columns | {"text": ascii_lower(F.col("text").cast("string"))}).values()))
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = checkpoint(docs.select("doc_id", "lang", leaf_digest(list(columns.values())).alias("leaf"),
                                  F.when(touched, tampered).alias("changed")))
    proofs, root = manifest(rows, "lang", "doc_id")
    leaf = _hex(F.col("leaf"))
    siblings = F.aggregate("path", F.lit(""), lambda a, s: F.concat(a, _hex(s["left"]), _hex(s["right"])))
    out = proofs.select("doc_id", leaf.alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"),
                        F.sha2(siblings, 256).alias("proof_sha256"),
                        fold(F.coalesce(_hex(F.col("changed")), leaf), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
