import random
import re
import textwrap

from churnlake.llm.licences import PHRASES, TEMPLATES, scan, template_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(text, templates, threshold):
    low = lower(text)
    words = WORD.findall(low)
    starts, labels = [], set()
    for p, label in PHRASES:
        p = p.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    matches = set()
    lines = low.split("\n")
    for i, n in ((i, n) for n in range(1, 5) for i in range(len(lines) - n + 1)):
        b = set(WORD.findall("\n".join(lines[i:i + n])))
        for label, t in template_words(templates):
            if len(b & set(t)) >= threshold * len(t) - 1e-9:
                matches.add((i, n, label, len(b & set(t)) / len(t)))
    return len(words), sorted(starts), labels, matches


def agree(df, templates=TEMPLATES, threshold=0.8):
    got = scan(df, ("text",), templates, threshold=threshold).collect()
    assert len(got) == df.count()
    for r in got:
        n, starts, labels, matches = plain(r["text"], templates, threshold)
        assert (r["n_words"], r["starts"], set(r["base_labels"])) == (n, starts, labels)
        assert {(m["line"], m["lines"], m["label"], m["containment"]) for m in r["matches"]} == matches


def test_random_blocks(spark):
    rng = random.Random(5)
    pool = [w for _, ws in template_words(TEMPLATES) for w in ws] + ["foo", "bar", "of", "the"]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(rng.randint(0, 4)):
            label, ws = rng.choice(template_words(TEMPLATES))
            line = rng.sample(ws, max(1, len(ws) - rng.randint(0, 4))) + rng.choices(pool, k=rng.randint(0, 12))
            rng.shuffle(line)
            lines.append(rng.choice([" ", ", ", "--"]).join(w.upper() if rng.random() < .3 else w for w in line))
        if rng.random() < .4:
            lines.append("x " + rng.choice([p for p, _ in PHRASES]).replace(" ", "; ") + " cc by nc cc BY-NC y")
        texts.append("\n".join(lines))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    agree(df)
    agree(df, threshold=0.5)
    agree(df, (("x", "the of"), ("y", "foo")), 1.0)


def test_odd_rows(odd_docs):
    agree(odd_docs)
    assert scan(odd_docs.limit(0)).count() == 0
    assert scan(odd_docs, templates=()).count() == odd_docs.count()


def test_wrapped_licenses(spark):
    """Every template, wrapped at 78 columns and starting inside a line, is found."""
    for indent in (0, 30, 70):
        rows = [(label, textwrap.fill("x" * indent + " " + text, 78) + "\nOther words follow here.") for label, text in TEMPLATES]
        got = scan(spark.createDataFrame(rows, "want string, text string"), ("want",)).collect()
        assert all(r["want"] in {m["label"] for m in r["matches"]} for r in got) and len(got) == len(TEMPLATES)
