"""Personal data: fixed patterns, and bootstrapped contextual extraction.

Seeds are the spans of the fixed patterns and tokens shaped like secrets (long
hexadecimal or mixed random strings).  Every identifier-like token (a digit or
@, five characters) is an instance.  Its lexical patterns are the two words
before it, the word before it with the shape of its token, and the words on
both sides.  On the graph of patterns and instances Spark scores in rounds: a pattern by the share of all its places in the corpus, whatever stands
there, that hold known instances; an instance by the patterns it stands in.  Patterns with enough distinct known instances and confidence make
their other instances known, and these score further patterns.  Instances in
accepted patterns outside the spans of the fixed patterns are the method's
spans; a secret's shape alone, without such a pattern, makes none.  Known instances
only grow, and the rounds end when none is added.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import load, text_of
from churnlake.session import checkpoint

KINDS = ("email", "ip", "card", "phone")
FOUND = "context"       # kind of the method's spans, after the fixed ones
MIN_SUPPORT = 3         # distinct known instances of an accepted pattern
MIN_CONFIDENCE = 0.6
HELD_PATTERNS = 500_000 # patterns that are broadcast for counting; more are counted by a shuffle
PATTERN_CHARS = 128     # a longer pattern is named by its hash
PARTIAL = 1_000_000     # counters that a task holds before it passes them on

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never begins inside a run of digits, so runs need no second look
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?()[]{}<>\"'"
_SECRET = re.compile(r"(?=[^0-9]*[0-9])(?:(?=.*[a-f])[0-9a-f]{32,}|(?=.*[A-F])[0-9A-F]{32,}|"
                     r"(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_+/=-]{32,})")
_HEX = re.compile(r"(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]+")
_RUNS = re.compile(r"([0-9]+)|([^\W\d_]+)")
_EXTRACTED = ("struct<base:array<struct<kind:string,start:int,end:int>>,"
              "edges:array<struct<patterns:array<string>,beside:string,instance:string,start:int,end:int,known:boolean,seed:boolean>>>")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                    if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _lower(word: str) -> str:
    return word.lower() if word.isascii() else word


def shape(core: str) -> str:
    """A token's form: h for hexadecimal digits with letters, else 9 for digits and a for letters, each with its
    length if it is one run; other characters as they are."""
    if len(core) >= 8 and _HEX.fullmatch(core):
        return f"h{len(core)}"
    if core.isalnum() and (core.isdigit() or core.isalpha()):
        return f"{'9' if core.isdigit() else 'a'}{len(core)}"
    return _RUNS.sub(lambda m: "9" if m[1] else "a", core)


def _named(pattern: str) -> str:
    return pattern if len(pattern) <= PATTERN_CHARS else hashlib.sha256(pattern.encode("utf-8", "surrogatepass")).hexdigest()


def patterns_at(before: tuple[str, str], word: str, after: str) -> tuple[str, str, str]:
    """The patterns of a token: two words before; word before and the token's shape; words on both sides."""
    return (_named(f"{before[0]} {before[1]}"), _named(f"{before[1]}\t{shape(word.strip(_EDGE))}"), _named(f"{before[1]}\n{after}"))


def instances(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[tuple, str, str, int, int, bool, bool]]:
    """(patterns, word before, instance, start, end, known, seed) of every identifier-like token; known: a span of the fixed
    patterns, once at its first token; seed: known, or shaped like a secret."""
    if not spans and not _DIGIT.search(text) and "@" not in text:
        return []
    out, before, k, due = [], ("^", "^"), 0, None
    cover = sorted((s, e) for _, s, e in spans)
    for m in _TOKEN.finditer(text):
        word = m[0]
        core = word.strip(_EDGE)
        if due:
            out.append((patterns_at(due[0], due[1], _lower(word)), due[0][1], *due[2]))
            due = None
        while k < len(cover) and cover[k][1] <= m.start():
            k += 1
        inside = k < len(cover) and cover[k][0] < m.end()
        if inside and m.start() > cover[k][0]:
            pass                                    # a later token of a span
        elif inside:
            s, e = cover[k]
            due = (before, word, (text[s:e], s, e, True, True))
        elif len(core) >= 5 and ("@" in core or _DIGIT.search(core)):
            start = m.start() + word.index(core)
            due = (before, word, (core, start, start + len(core), False, len(core) >= 32 and bool(_SECRET.fullmatch(core))))
        before = (before[1], _lower(word))
    if due:
        out.append((patterns_at(due[0], due[1], "$"), due[0][1], *due[2]))
    return out


def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        base = [base_spans(t) for t in texts]
        edges = [instances(t, b) for t, b in zip(texts, base)]
        yield pd.DataFrame({
            "base": [[{"kind": k, "start": s, "end": e} for k, s, e in b] for b in base],
            "edges": [[dict(zip(("patterns", "beside", "instance", "start", "end", "known", "seed"), r)) for r in rows] for rows in edges]})


def _places(held: frozenset | None, beside: frozenset | None):
    """(pattern, total) partial counts of the patterns at all tokens; of ``held`` only, ``beside``: the words before
    the token in its patterns.  None: of all patterns."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def passed_on() -> pd.DataFrame:
            out = pd.DataFrame({"pattern": list(seen), "total": list(seen.values())}).astype({"pattern": "object", "total": "int64"})
            seen.clear()
            return out

        for pdf in batches:
            for text in pdf["text"]:
                raw = _TOKEN.findall(text)
                words = ["^", "^", *map(_lower, raw), "$"]
                for i, word in enumerate(raw):
                    if beside is not None and words[i + 1] not in beside:
                        continue
                    for p in patterns_at((words[i], words[i + 1]), word, words[i + 3]):
                        if held is None or p in held:
                            seen[p] += 1
                    if len(seen) >= PARTIAL:
                        yield passed_on()
        yield passed_on()

    return count


def pattern_totals(docs: DataFrame, patterns: DataFrame, most: int = HELD_PATTERNS) -> DataFrame:
    """(pattern, total): at how many tokens of the corpus each of ``patterns`` (pattern, beside) stands, whatever the
    token.  Up to ``most`` patterns are broadcast, and only their counts leave the tasks; more are counted by a
    shuffle of partial counts.  Both count all of them."""
    spark = docs.sparkSession
    patterns = checkpoint(patterns)
    texts = docs.select(text_of().alias("text"))
    counts = "pattern string, total long"
    if patterns.count() <= most:
        rows = patterns.collect()
        found = texts.mapInPandas(_places(frozenset(r["pattern"] for r in rows), frozenset(r["beside"] for r in rows)), counts)
    else:
        found = texts.mapInPandas(_places(None, None), counts).join(patterns.select("pattern").distinct(), "pattern", "left_semi")
    return checkpoint(found.groupBy("pattern").agg(F.sum("total").alias("total")))


def extract(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base (array of kind, start, end), found (array of start, end).

    Null and empty texts have no spans; a text of any length is taken as a whole by one task; repeated rows and rows
    with one or no id stay, each with its spans, and their places count each; a pattern that reaches both thresholds
    exactly is accepted; an empty table gives no rows; of extra columns none is read.
    """
    rows = checkpoint(docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("rid"), F.pandas_udf(_extract, _EXTRACTED)(text_of()).alias("x"))
                      .select("doc_id", "rid", "x.base", "x.edges"))
    places = rows.select("rid", F.explode("edges").alias("e")).select("rid", "e.*").withColumn("pattern", F.explode("patterns"))
    edges = checkpoint(places.groupBy("pattern", "instance").agg(
        F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"), F.min("beside").alias("beside")))
    wide = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.min("beside").alias("beside"))
    totals = pattern_totals(docs, wide.where(F.col("instances") >= MIN_SUPPORT).select("pattern", "beside"))
    graph = checkpoint(edges.join(totals, "pattern"))
    known = checkpoint(edges.where("seed").select("instance").distinct())
    size = known.count()
    while True:
        hit = graph.join(known.withColumnRenamed("instance", "k"), F.col("instance") == F.col("k"), "left")
        accepted = checkpoint(hit.groupBy("pattern", "total").agg(
            F.sum(F.when(F.col("k").isNotNull(), F.col("n")).otherwise(0)).alias("known_n"), F.count("k").alias("support"))
            .withColumn("confidence", F.least(F.col("known_n") / F.col("total"), F.lit(1.0)))
            .where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE)).select("pattern", "confidence"))
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        more = graph.join(accepted, "pattern").groupBy("instance").agg((1 - F.exp(doubt)).alias("score"))
        known = checkpoint(known.union(more.where(F.col("score") >= MIN_CONFIDENCE).select("instance")).distinct())
        now = known.count()
        if now == size:
            break
        size = now
    found = (places.where("NOT known").join(accepted, "pattern").groupBy(F.col("rid").alias("f_rid"))
             .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("found")))
    return rows.join(found, F.col("rid") == F.col("f_rid"), "left").select(
        "doc_id", "base", F.coalesce("found", F.array().cast("array<struct<start:int,end:int>>")).alias("found"))


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    out = extract(load(spark, sf_dir, "documents"))
    say = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    extra = F.transform("found", lambda s: F.struct(F.lit(FOUND).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    place = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])
    both = F.array_sort(F.transform(F.concat("base", extra), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(place, s["kind"]).alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return out.select(
        "doc_id", *[F.size(F.filter("base", _is(k))).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform("base", say), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(both, say), ",").alias("spans"))


def _is(kind: str):
    return lambda s: s["kind"] == kind
