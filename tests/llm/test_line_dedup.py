import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from churnlake.llm.line_dedup import (GRAM_WORDS, SURE_WORDS, drop_repeated_runs, extend, repeated_runs, run_hashes, smallest_between,
                                      smallest_in_runs, unit_table)
from churnlake.llm.tokens import buffers

STOP = re.compile(r"[.!?]+(?=[\x20\x09\x0B-\x0D])")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def units(text):
    """(words, start, end) of the non-empty units."""
    out, at = [], 0
    for line in text.split("\n"):
        a = 0
        for b in [*[m.end() for m in STOP.finditer(line)], len(line)]:
            words = tuple(re.findall("[^\x20\x09-\x0D]+", lower(line[a:b])))
            if words:
                out.append((words, at + a, at + b))
            a = b
        at += len(line) + 1
    return out


def hashes_of(text):
    return unit_table(*buffers(pa.array([text])))["hash"]


def fingerprints(hashes, words):
    """(first unit, units) by definition, one window after the other."""
    def end(i, n):
        total = 0
        for j in range(i, len(words)):
            total += words[j]
            if total >= n:
                return j + 1
        return None

    value = {j: int(run_hashes(hashes, np.array([j]), np.array([end(j, GRAM_WORDS)]))[0]) for j in range(len(words)) if end(j, GRAM_WORDS)}
    chosen = set()
    for i in range(len(words)):
        if (sure := end(i, SURE_WORDS)) is not None:
            inside = [j for j in range(i, len(words)) if j in value and end(j, GRAM_WORDS) <= sure]
            chosen.add(min(inside, key=lambda j: (value[j], -j)))
    return [(j, end(j, GRAM_WORDS) - j) for j in sorted(chosen)]


def test_units_of_a_block():
    texts = ["", "One two. Three!? four\n\n  five.\r\nsix .. seven.", "É À. ß\t\nx", "a.b c.", " \n", "... !\n?", "end. "]
    t = unit_table(*buffers(pa.array(texts)))
    got = [(int(r), int(n), int(s), int(e)) for r, n, s, e in zip(t["row"], t["words"], t["start"], t["end"])]
    assert got == [(i, len(w), s, e) for i, x in enumerate(texts) for w, s, e in units(x)]
    contents = [w for x in texts for w, _, _ in units(x)]
    assert len(set(t["hash"].tolist())) == len(set(contents)) == len(set(zip(t["hash"].tolist(), contents)))


def test_smallest_between():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 9, 200).astype(np.uint64)
    first = rng.integers(0, 200, 300)
    last = np.minimum(first + rng.integers(0, 40, 300), 199)
    for a, b, g in zip(first, last, smallest_between(values, first, last)):
        assert g == max(i for i in range(a, b + 1) if values[i] == values[a:b + 1].min())


def test_smallest_in_runs():
    values = np.random.default_rng(2).integers(0, 5, 100).astype(np.uint64)
    for n in (1, 2, 3, 26, 100):
        at = np.arange(100 - n + 1)
        assert smallest_in_runs(values, n).tolist() == smallest_between(values, at, at + n - 1).tolist()


def plain_runs(own, other, seeds):
    """Every seed extended value by value; runs that overlap are one."""
    out = []
    for pos, at, n in seeds:
        if at + n > len(other) or own[pos:pos + n] != other[at:at + n]:
            continue
        a, b = pos, pos + n
        while a > 0 and a - pos + at > 0 and own[a - 1] == other[a - 1 - pos + at]:
            a -= 1
        while b < len(own) and b - pos + at < len(other) and own[b] == other[b - pos + at]:
            b += 1
        out.append((a, b))
    held = []
    for a, b in sorted(out):
        if held and a < held[-1][1]:
            held[-1] = (held[-1][0], max(b, held[-1][1]))
        else:
            held.append((a, b))
    return held


def flat(texts):
    return np.concatenate([np.array(t, np.int64) for t in texts]), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def test_extension_of_many_pairs():
    rng = random.Random(5)
    for values in (2, 3, 4):
        for _ in range(60):
            pairs = [[[rng.randrange(values) for _ in range(rng.randint(0, 90))] for _ in range(2)] for _ in range(rng.randint(1, 5))]
            seeds = [(i, p, q, 3) for i, (x, y) in enumerate(pairs) for p in range(len(x) - 2) for q in range(len(y)) if rng.random() < .05]
            got = extend(*flat([x for x, _ in pairs]), *flat([y for _, y in pairs]), *np.array(seeds, np.int64).reshape(-1, 4).T)
            assert list(zip(*[g.tolist() for g in got])) == [
                (i, *run) for i, (x, y) in enumerate(pairs) for run in plain_runs(x, y, [s[1:] for s in seeds if s[0] == i])]


def test_text_that_repeats_itself_is_extended_once(monkeypatch):
    import churnlake.llm.line_dedup as line_dedup
    compared, agree = [], line_dedup._agree
    monkeypatch.setattr(line_dedup, "_agree", lambda *a: compared.append(int(a[4].sum())) or agree(*a))
    n = 4000
    own = np.array([7, *[1] * n, 8], np.int64)
    pos = np.arange(1, n - 1)
    at = np.array([0, len(own)])
    got = extend(own, at, own[1:-1], np.array([0, n]), np.zeros(len(pos), np.int64), pos, np.zeros(len(pos), np.int64), np.full(len(pos), 3))
    assert [g.tolist() for g in got] == [[0], [1], [n + 1]]
    assert sum(compared) < 3 * n        # n * n / 2 if every place is compared to its end


def test_one_row_for_each_pair(spark, monkeypatch):
    """Repeated lines give as many matches as places; the runs of a pair come together."""
    made, frame = {}, type(spark.range(1))
    rows_of = frame.mapInArrow

    def counted(self, f, schema, *a, **k):
        out = rows_of(self, f, schema, *a, **k)
        if f.__name__ in ("_extended", "_words_extended"):
            made[f.__name__] = (self.count(), out.count())
        return out

    monkeypatch.setattr(frame, "mapInArrow", counted)
    line = " ".join(f"w{k}" for k in range(55)) + "."
    rows = [(i, "".join(f"{line}\nown {i} {k}.\n" for k in range(20))) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: tuple(r["removed"]) for r in repeated_runs(docs).collect()} == {i: tuple(range(0 if i else 2, 40, 2)) for i in range(8)}
    assert set(made) == {"_extended", "_words_extended"} and all(0 < out <= pairs for pairs, out in made.values())


def plain(rows):
    """Every fingerprint against the first place of its content, extended unit by unit."""
    seqs, place, out = [], {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        u = units(t or "")
        seqs.append(([x[0] for x in u], [len(x[0]) for x in u], i, hashes_of(t or "")))
    for k, (hashes, words, _, h) in enumerate(seqs):
        for pos, n in fingerprints(h, words):
            place.setdefault(tuple(hashes[pos:pos + n]), (k, pos))
    for k, (hashes, words, i, h) in enumerate(seqs):
        gone = set()
        for pos, n in fingerprints(h, words):
            src, at = place[tuple(hashes[pos:pos + n])]
            if (src, at) == (k, pos):
                continue
            other, a, b = seqs[src][0], pos, pos + n
            while a > 0 and a - pos + at > 0 and hashes[a - 1] == other[a - 1 - pos + at]:
                a -= 1
            while b < len(hashes) and b - pos + at < len(other) and hashes[b] == other[b - pos + at]:
                b += 1
            gone |= set(range(a, b))
        out.append((i, len(hashes), tuple(sorted(gone))))
    return Counter(out)


def texts(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=3))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(3, 14))) + "."
    shared = [[sentence() for _ in range(rng.randint(5, 14))] for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [sentence() for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(parts))
            parts[at:at] = rng.choice(shared)
        rows.append((i, "".join(p + rng.choice([" ", "\n", "\n\n"]) for p in parts)))
    return rows, shared


def test_against_plain_matching(spark, odd_docs):
    rows, _ = texts()
    rows += [(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] not in (None, 7)]
    rows = [(i if i is None else i * 10 + n, t) for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r["doc_id"], r["n_units"], tuple(r["removed"])) for r in repeated_runs(docs).collect())
    assert got == plain(rows)


def test_passages_of_50_words_go(spark):
    rows, shared = texts(8)
    left = {r["doc_id"]: r["text"] for r in drop_repeated_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for passage in shared:
        if sum(len(s.split()) for s in passage) < 50:
            continue
        has = lambda t: " ".join(" ".join(passage).split()) in " ".join(t.split())
        holders = [i for i, t in rows if has(t)]
        assert [i for i in holders if has(left[i])] == holders[:1]


def test_odd_rows(odd_docs):
    got = repeated_runs(odd_docs)
    assert got.count() == odd_docs.count() and repeated_runs(odd_docs.limit(0)).count() == 0
    assert drop_repeated_runs(odd_docs).columns == odd_docs.columns
    assert drop_repeated_runs(odd_docs.limit(0)).count() == 0


def test_passages_cut_inside_units_go(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    words = lambda n: [word() for _ in range(n)]
    rows, passages = [], []
    for k, n in enumerate((50, 59, 80, 120)):
        passage = words(n)
        if n == 80:
            passage[39] += "."              # whole units of fewer than 25 words inside
            passage[60] += "."
        passages.append(" ".join(passage))
        for i in range(3):
            rows.append((10 * k + i, " ".join([*words(7 + i), *passage, *words(9 - i)]) + ".\nTail " + " ".join(words(4)) + "."))
    rows.append((90, " ".join([*words(6), *passages[1].split()[:24], *words(30)])))       # under 25 words stay
    rows.append((None, "x " + passages[0].upper().replace(" ", "\n", 3) + " y"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = {r["doc_id"]: r["text"] for r in drop_repeated_runs(docs).collect()}
    for i, t in rows:
        if i == 90 or (i is not None and i % 10 == 0):
            assert left[i] == t
        elif i is None:
            assert left[i].split() == ["x", "y"]
        else:
            assert left[i] == t.replace(passages[i // 10], "")
    got = {r["doc_id"]: r for r in repeated_runs(docs).collect()}
    assert [got[i]["n_removed_words"] for i in (0, 1, 11, 22, 32, 90, None)] == [0, 50, 59, 80, 120, 0, 50]


def test_runs_of_words_against_all_places(spark):
    """Every run of 50 words or more that an earlier text holds is gone, whatever its edges; words that no earlier
    text holds in a run of 25 stay.  Few pairs a task, so the hot source is dealt out."""
    import churnlake.llm.line_dedup as line_dedup
    rng = random.Random(12)
    words = lambda n: ["".join(rng.choices("abcdefghij", k=12)) for _ in range(n)]
    common, other = words(130), words(70)
    rows = []
    for i in range(60):
        a = rng.randint(0, 40)
        rows.append((i, " ".join([*words(rng.randint(0, 8)), *common[a:a + 50 + rng.randint(0, 40)], *words(5)]) + "."))
        if i % 3 == 0:
            rows[-1] = (i, rows[-1][1] + "\n" + " ".join([*words(3), *other, *words(2)]))
    kept, line_dedup.HOT_PAIRS = line_dedup.HOT_PAIRS, 4
    try:
        left = {r["doc_id"]: r["text"].split() for r in drop_repeated_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        line_dedup.HOT_PAIRS = kept
    clean = lambda ws: [w.strip(".") for w in ws]
    first: dict = {}
    for i, t in rows:
        ws = clean(t.split())
        for k in range(len(ws) - 24):
            first.setdefault(tuple(ws[k:k + 25]), i)
    for i, t in rows:
        ws, out = clean(t.split()), clean(left[i])
        old = [any(first[tuple(ws[j:j + 25])] < i for j in range(max(0, k - 24), min(k, len(ws) - 25) + 1)) for k in range(len(ws))]
        assert [w for w, o in zip(ws, old) if not o] == [w for w in out if w in {x for x, o in zip(ws, old) if not o}]
        for e in range(i):
            theirs = {tuple(clean(rows[e][1].split())[j:j + 50]) for j in range(len(rows[e][1].split()) - 49)}
            assert not any(tuple(out[j:j + 50]) in theirs for j in range(len(out) - 49))


def test_clashing_columns(spark):
    names = ["doc_id", "text", "key_id", "key_h", "spans", "cut", "rid", "c_0", "__id", "hashes"]
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(60)), *["v"] * 8) for i in (1, 2)], names)
    got = {r["doc_id"]: r for r in drop_repeated_runs(docs).collect()}
    assert got[2]["text"] == "" and got[1]["text"].split()[59] == "w59" and got[2]["spans"] == "v"
