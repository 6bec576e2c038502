import random
import re
from collections import Counter

from churnlake.llm.decontamination import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, n=10):
    words, hit, ids = words_of(text), set(), set()
    for item, bench in items:
        b = words_of(bench)
        k = min(n, len(b))
        grams = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)} if b else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                ids |= {str(item)} if item is not None else set()
    return len(words), sorted(hit), sorted(ids)


def cases():
    rng = random.Random(3)
    vocab = ["a", "b", "c", "d", "É"]
    say = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    items = [(i, say(rng.choice([0, 1, 6, 7, 10, 14, 25]))) for i in range(2, 14)] + [(1, None), (None, say(12)), (20, "the only")]
    items = [(i, t) for i, t in items if len(words_of(t)) != 1]
    texts = [say(rng.randint(0, 40)) for _ in range(60)] + [None, "", "x The, ONLY! the only", "only the"]
    texts += [say(5) + ". " + (rng.choice(items)[1] or "").upper() + " " + say(4) for _ in range(20)]
    return texts, items


def test_against_plain_search(spark):
    texts, items = cases()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (64 << 20, 0):     # with a broadcast and with a shuffle
        got = {r["doc_id"]: (r["n_words"], r["hit"], r["items"]) for r in contamination(docs, bench, limit=limit).collect()}
        assert got == {i: plain(t, items) for i, t in enumerate(texts)}


def test_removal(spark):
    texts, items = cases()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, hit string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = {r["doc_id"] for r in decontaminate(docs, bench).collect()}
    assert kept == {i for i, t in enumerate(texts) if not plain(t, items)[1]}
    for r in decontaminate(docs, bench, remove="spans").collect():
        text = texts[r["doc_id"]]
        _, hit, _ = plain(text, items)
        left = [w for i, w in enumerate(words_of(text)) if i not in set(hit)]
        assert words_of(r["text"]) == left and (r["text"] == text or hit)


def test_odd_rows(spark, odd_docs):
    items = [(1, "one two three four five six seven eight nine ten"), (2, "same text here"), (3, "alpha beta gamma delta alpha")]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, hash int")
    got = Counter((r["doc_id"], r["n_words"], tuple(r["hit"]), tuple(r["items"])) for r in contamination(odd_docs, bench).collect())
    want = Counter((r["doc_id"], *map(lambda x: tuple(x) if isinstance(x, list) else x, plain(r["text"], items))) for r in odd_docs.collect())
    assert got == want
    assert decontaminate(odd_docs, bench).columns == odd_docs.columns
    assert contamination(odd_docs.limit(0), bench).count() == 0
    assert all(not r["hit"] for r in contamination(odd_docs, bench.limit(0)).collect())
    assert decontaminate(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_long_text_and_shared_window(spark):
    """A text of 20,000 words, and a prompt that all of 3,000 items share, in both forms of the join."""
    prompt = "answer the next question with one word and nothing else please"
    bench = spark.createDataFrame([(i, f"{prompt} number {i}") for i in range(3000)], "item_id long, text string")
    long = " ".join(f"w{i % 977}" for i in range(10000)) + f" {prompt} " + " ".join(f"v{i % 331}" for i in range(9989))
    docs = spark.createDataFrame([(1, long, "x"), (2, "w1 w2", "y")], "doc_id long, text string, set string")
    for limit in (64 << 20, 0):
        got = {r["doc_id"]: r for r in contamination(docs, bench, limit=limit).collect()}
        assert got[1]["hit"] == list(range(10000, 10011)) and len(got[1]["items"]) == 3000 and got[1]["n_words"] == 20000
        assert got[2]["hit"] == [] and got[2]["items"] == []


def test_clashing_columns(spark):
    names = ["doc_id", "text", "hit", "key_id", "key_h", "bad_id", "c_0", "rid", "__id", "__h", "words", "cleaned"]
    docs = spark.createDataFrame([(1, "a b", *[f"v{i}" for i in range(10)]), (2, "only the", *["w"] * 10)], names)
    bench = spark.createDataFrame([(1, "only the")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate(docs, bench).collect()] == [(1, "a b", *[f"v{i}" for i in range(10)])]
    assert {r["text"] for r in decontaminate(docs, bench, remove="spans").collect()} == {"a b", ""}
