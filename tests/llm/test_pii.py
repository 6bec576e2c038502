import random
import re

from collections import Counter

from churnlake.llm.pii import KINDS, base_spans, extract, luhn, pattern_totals, patterns_at, shape
from churnlake.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def plain(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def test_base_against_the_patterns():
    rng = random.Random(1)
    pieces = ["a", "é", "@", "@b.", ".", "c.d", "x_y", "-", "+", "+1 (635) 555-6187", "4999938345101225", "4100 3622 8496 5923", "10.0.0.1", "256.1",
              "1.2.3.4.5", "0001.2.3.255", " ", "  ", "12", "(", ")", "me.x+y%z@mail1.example.com", "\n", "😀", "999999999999999999999"]
    for _ in range(6000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 12)))
        assert base_spans(text) == plain(text), text
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 50_000, "+1" * 50_000):
        assert isinstance(base_spans(text), list)      # linear time


def test_bootstrapping(spark, odd_docs):
    rng = random.Random(2)
    rows = [f"please write to: user{i}@mail{i}.example.com now" for i in range(12)]
    rows += [f"please write to: user{i}#example-{i} now" for i in range(3)]            # unseen form, learned pattern
    rows += [f"staff reach via user{i}#example-{i} there" for i in range(3)]           # second round: via learned instances
    rows += ["staff reach via desk4711x there"]
    rows += [f"room of {1000 + rng.randrange(9000)}x and of the b{i}@c.de" for i in range(5)] + ["of the day"] * 40
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in extract(docs).collect()}
    found = {i: [rows[i][s["start"]:s["end"]] for s in r["found"]] for i, r in got.items()}
    assert [found[i] for i in range(12, 15)] == [[f"user{i}#example-{i}"] for i in range(3)]
    assert found[18] == ["desk4711x"]
    assert all(not found[i] for i in range(19, len(rows))) and all(not found[i] for i in range(12))
    odd = extract(odd_docs)
    assert odd.count() == odd_docs.count() and extract(odd_docs.limit(0)).count() == 0


def test_bootstrapping_goes_on_until_nothing_is_added(spark):
    rows = [f"please write to: user{i}@mail{i}.example.com now" for i in range(12)]
    rows += [f"please write to: id-0-{i}x now" for i in range(3)]
    for k in range(1, 6):               # pattern k is reached through the instances of pattern k - 1
        rows += [f"hop{k} goes via{k} id-{k - 1}-{i}x there" for i in range(3)] * 2
        rows += [f"hop{k} goes via{k} id-{k}-{i}x there" for i in range(3)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"]: [rows[r["doc_id"]][s["start"]:s["end"]] for s in r["found"]] for r in extract(docs).collect()}
    assert all(found[i] == [w for w in t.split() if w.startswith("id-")] for i, t in enumerate(rows))


def test_secrets_in_a_repeated_context(spark):
    rng = random.Random(3)
    key = lambda n=40: "".join(rng.choices("0123456789abcdef", k=n - 2)) + "a1"
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = [f'{word()} {word()} token = "{key()}" {word()}' for _ in range(30)]
    rows += [f'{word()} token = "short-{i}77" {word()}' for i in range(2)]       # found by the pattern, not by its shape
    rows += [f"{word()} {word()} {key()} {word()}" for _ in range(5)]            # the shape without a repeated context
    rows += [f"{word()} {word()} {4000 + i}x9 {word()}" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r["doc_id"]: [rows[r["doc_id"]][s["start"]:s["end"]] for s in r["found"]] for r in extract(docs).collect()}
    for i, t in enumerate(rows):
        assert found[i] == ([t.split('"')[1]] if "token" in t else []), t


def test_pattern_totals_by_broadcast_and_by_shuffle(spark):
    texts = ["a b 1234x c", "a b c", "b 1234y c", None, "", "a " * 400 + "b", "w" * 300 + " b 77777"]
    want: Counter = Counter()
    for t in texts:
        raw = (t or "").split()
        words = ["^", "^", *raw, "$"]
        for i, w in enumerate(raw):
            want.update(patterns_at((words[i], words[i + 1]), w, words[i + 3]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = [("a b", "b"), ("b\t" + shape("1234x"), "b"), ("b\nc", "b"), ("^ ^", "^"), patterns_at(("w" * 300, "b"), "77777", "$")[0:1] + ("b",)]
    asked = spark.createDataFrame(asked, "pattern string, beside string")
    for most in (100, 1):
        got = {r["pattern"]: r["total"] for r in pattern_totals(docs, asked, most).collect()}
        assert got == {p: want[p] for (p, _) in asked.collect()}


def test_query(spark, write_tables):
    docs = spark.createDataFrame([(1, "é a@b.co 10.0.0.1"), (2, None), (None, "")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in QUERIES["op7_bootstrapped_pii"](spark, write_tables(documents=docs)).collect()}
    assert rows[1]["spans"] == "email:2:8,ip:9:17" and (rows[1]["n_email"], rows[1]["n_ip"]) == (1, 1)
    assert rows[2]["spans"] == rows[None]["spans"] == ""
