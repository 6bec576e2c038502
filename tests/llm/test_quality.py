import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from churnlake.llm import quality
from churnlake.llm.quality import DIMENSIONS, Space, counted, document_frequencies, fit, op11_latent_quality, scored, term_counts
from churnlake.llm.tokens import LOWER, buffers, hash_words, word_table

DATA = "/root/testdata/sf0.01"


def whole(text):
    return term_counts(*buffers(pa.array([text])))[0]


def test_word_hashes():
    rng = random.Random(3)
    texts = ["", "A b c  a\tA\n", "  ", "É é", "x" * 9000 + " " + "x" * 9000 + " " + "x" * 8999 + "y", "one"]
    texts += [" ".join(rng.choice(["Ab", "aB", "ab", "ba", "c", "cc"]) for _ in range(40)) for _ in range(20)]
    data, offsets = buffers(pa.array(texts))
    starts, ends, row = word_table(data, offsets)
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall("[^\x20\x09-\x0D]+", t)]
    assert [(r, bytes(data[s:e]).decode()) for r, s, e in zip(row, starts, ends)] == want
    hashes = hash_words(LOWER[data], starts, ends)
    lowered = [bytes(LOWER[data[s:e]]) for s, e in zip(starts, ends)]
    assert len(set(hashes.tolist())) == len(set(lowered)) == len(set(zip(hashes.tolist(), lowered)))


def test_terms_of_sliced_and_long_texts(monkeypatch):
    texts = ["a b", "Über Öl!! |", "w" * 50 + " ", "", " ".join(f"w{i % 97}" for i in range(3000)), "z z z"]
    want = [whole(t) for t in texts]
    for limit in (1 << 19, 64):
        monkeypatch.setattr(quality, "BLOCK_BYTES", limit)
        for array in (pa.array(texts), pa.array(["x", *texts, "y"]).slice(1, len(texts)), pa.array(texts, pa.large_string())):
            got = [(at + i, row) for at, counts in counted(array) for i, row in enumerate(counts)]
            assert [at for at, _ in got] == list(range(len(texts)))
            for (_, row), w, t in zip(got, want, texts):
                if limit > 64 or len(t) < 64:
                    assert (row == w).all()
                else:                                   # pairs across a cut are not counted
                    assert 0 <= w.sum() - row.sum() <= 2 * len(t) // 64


def test_votes_against_plain_loops():
    rng = np.random.default_rng(2)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    labelled = unit(rng.normal(size=(60, 5)).astype(np.float32))
    labels = (rng.random(60) < 0.7).astype(float)
    space = Space(np.ones(DIMENSIONS, np.float32), np.zeros((DIMENSIONS, 5), np.float32), labelled, labels)
    vectors = np.vstack([unit(rng.normal(size=(30, 5)).astype(np.float32)), np.zeros((1, 5), np.float32)])
    got = space.vote(vectors, 7)
    for v, g in zip(vectors, got):
        near = [round(max(0.0, float(np.float32(v @ x))), 5) for x in labelled]
        least = sorted(near, reverse=True)[6]
        votes = [n ** 4 if n >= least else 0.0 for n in near]
        want = sum(w * y for w, y in zip(votes, labels)) / sum(votes) if sum(votes) else labels.mean()
        assert math.isclose(g, want, abs_tol=2e-4)
    assert (Space(space.weights, space.axes, labelled[:0], labels[:0]).vote(vectors) == 0.5).all()


def test_frequencies_cover_the_corpus(spark, odd_docs):
    seen, n = document_frequencies(odd_docs)
    rows = [whole(r["text"] or "") for r in odd_docs.collect()]
    assert n == len(rows) and (seen == (np.array(rows) > 0).sum(axis=0)).all()
    assert document_frequencies(odd_docs.limit(0))[1] == 0


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, 1), (6, 0), (7, 1), (8, None), (None, 0), (99, 0)], "doc_id long, quality int")
    out = scored(odd_docs, fit(odd_docs, labels), ["doc_id"]).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r["doc_id"]) for r in odd_docs.collect())
    assert all(0 <= r["score"] <= 1 for r in out)
    by_text = {}
    for r, d in zip(out, odd_docs.collect()):
        by_text.setdefault((d["text"] or "").strip(), set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())
    none = fit(odd_docs, labels.where("false"))
    assert {r["score"] for r in scored(odd_docs, none, ["doc_id"]).collect()} == {0.5}
    assert scored(odd_docs.limit(0), none, ["doc_id", "label"]).count() == 0


@pytest.mark.slow
def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in op11_latent_quality(spark, DATA).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    held = [i for i in labels if rows[i]["held_out"]]
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)
    assert sum(rows[i]["predicted"] == labels[i] for i in held) >= 0.97 * len(held)
    assert [rows[i]["score"] for i in sorted(rows)] == [r["score"] for r in sorted(op11_latent_quality(spark, DATA).collect(), key=lambda r: r["doc_id"])]
