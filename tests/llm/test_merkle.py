import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from churnlake.llm.merkle import FIELDS, leaf_digest, manifest, op12_merkle_manifest
from churnlake.session import checkpoint


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(t):
    return t if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def climb(digests):
    """The levels of a tree, from its leaves."""
    levels = [digests]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i:i + 8]) for i in range(0, len(now), 8)])
    return levels


def proof(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append((level[run:at], level[at + 1:run + 8]))
        at //= 8
    return out


def plain(rows):
    """Rows of the query, from (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        leaf = h(*map(coded, r))
        groups[r[2]].append((r[0], leaf, h(*map(coded, (*r[:4], lowered(r[4])))) if changed else leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = climb([r[1] for r in groups[g]])
    top = climb([trees[g][-1][0] for g in order])
    out = Counter()
    for g in order:
        for i, (doc_id, leaf, changed) in enumerate(groups[g]):
            path = proof(trees[g], i) + proof(top, order.index(g))
            folded = changed
            for left, right in path:
                folded = h(*left, folded, *right)
            out[(doc_id, leaf, trees[g][-1][0], top[-1][0], h(*[d for left, right in path for d in left + right]), folded,
                 folded == top[-1][0])] += 1
    return out


def collected(df):
    return Counter(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9}, {None: 1, "en": 700, "é": 65, "null": 8, "Z": 1, "zz": 64}])
def test_against_plain_trees(spark, write_tables, sizes):
    rows = []
    for lang, n in sizes.items():
        rows += [(len(rows) + k * 7 % (n + 1), f"s{k % 3}", lang, k, f"Text {k % 11} of {lang}") for k in range(n)]
    got = collected(op12_merkle_manifest(spark, write_tables(documents=table(spark, rows).repartition(5))))
    assert got == plain(rows)
    assert sum(got.values()) == len(rows)


def test_many_groups(spark, write_tables):
    rows = [(k, "s", f"lang{k % 90}", k, f"T{k}") for k in range(200)]
    assert collected(op12_merkle_manifest(spark, write_tables(documents=table(spark, rows)))) == plain(rows)


def test_odd_rows(spark, write_tables, odd_docs):
    rows = [tuple(r[c] for c in FIELDS) for r in odd_docs.collect()]
    assert collected(op12_merkle_manifest(spark, write_tables(documents=odd_docs))) == plain(rows)


def test_empty_table(spark, write_tables, odd_docs):
    assert op12_merkle_manifest(spark, write_tables(documents=odd_docs.limit(0))).count() == 0


def test_untouched_documents_verify_and_columns_may_clash(spark):
    docs = table(spark, [(k, "s", "en" if k % 5 else "de", k, f"t{k}") for k in range(100)])
    rows = checkpoint(docs.select("lang", "doc_id", leaf_digest([F.col(c) for c in FIELDS]).alias("leaf"), F.lit(1).alias("tree"), F.lit(2).alias("idx")))
    proofs, root = manifest(rows, "lang", "doc_id")
    assert proofs.columns == ["lang", "doc_id", "leaf", "tree", "idx", "subroot", "path"]
    assert proofs.count() == 100 and len(root) == 64
