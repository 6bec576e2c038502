import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from churnlake.llm import exact_dedup
from churnlake.llm.exact_dedup import exact_groups, rice_decode, rice_encode


@pytest.mark.parametrize("k", [0, 1, 7, 40])
def test_rice_round_trip(k):
    rng = np.random.default_rng(k)
    gaps = rng.integers(0, max(2, (1 << k) * 3), 500).astype(np.int64)
    gaps[:3] = 0
    assert (rice_decode(*rice_encode(gaps, k), len(gaps), k) == gaps).all()


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = Counter()
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        for n, i in enumerate(ids):
            out[(i, ids[0], len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("chunk_bits,extra_bits", [(20, 16), (3, 16), (3, 0)])
def test_against_plain_groups(spark, odd_docs, monkeypatch, chunk_bits, extra_bits):
    monkeypatch.setattr(exact_dedup, "CHUNK_BITS", chunk_bits)
    monkeypatch.setattr(exact_dedup, "EXTRA_BITS", extra_bits)      # 0: many suspects without a copy
    rng = random.Random(4)
    rows = [(i, rng.choice(["a b", "a  b", "\na b", f"t{rng.randrange(150)} x", "hot", "hot", None, ""])) for i in range(600)]
    rows += [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert Counter(map(tuple, exact_groups(docs).collect())) == plain(rows)


def test_odd_rows(odd_docs):
    assert exact_groups(odd_docs).where("kept").count() == len(plain([(r["doc_id"], r["text"]) for r in odd_docs.collect()]) and {
        re.sub("[\x20\x09-\x0D]+", " ", r["text"] or "") for r in odd_docs.collect()})
    assert exact_groups(odd_docs.limit(0)).count() == 0
