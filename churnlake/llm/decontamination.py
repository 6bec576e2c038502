"""Benchmark decontamination by a hash set of the test items' word windows.

Every window of ``n`` consecutive item words (an item of fewer is one window)
is hashed; the set of distinct windows is broadcast if its measured bytes stay
under a bound and joined by a shuffle beyond it.  Each word of a document is
hashed once, every window is looked up by the hash of its words' hashes, and a
hit is verified word for word.  A document
keeps one row even without hits, so one pass over the texts gives the whole
report: a partial aggregate brings a document's hits together, and only those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import BROADCAST_BYTES, all_of, any_of, ascii_lower, load, text_of, words_of
from churnlake.session import checkpoint

WINDOW = 10
# a word of a text that still has its capitals, with what stands before it; and what stands after the last word
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TAIL = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*$"


def _windows(words: Column, hashes: Column, length: int, own_words: bool) -> Column:
    """Structs (hash, pos, len) of all windows of ``length`` words, hashed from the words' hashes; with
    ``own_words`` also the window's words."""
    kind = "array<struct<hash:bigint,pos:int,len:int" + (",gram:array<string>" if own_words else "") + ">>"
    more = [lambda i: F.slice(words, i + 1, length).alias("gram")] if own_words else []
    return F.when(F.size(words) >= length, F.transform(
        F.sequence(F.lit(0), F.size(words) - length),
        lambda i: F.struct(F.xxhash64(F.slice(hashes, i + 1, length)).alias("hash"), i.alias("pos"),
                           F.lit(length).alias("len"), *[m(i) for m in more]))).otherwise(F.array().cast(kind))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct windows (hash, gram, items): items holds the sorted ids, as strings, of the items with the window.
    Items with a null id count under no name; items without words have no window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(ascii_lower(text_of())).alias("words"))
    length = F.least(F.size("words"), F.lit(n))
    grams = items.where(F.size("words") > 0).select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("words") - length), lambda i: F.slice("words", i + 1, length))).alias("gram"))
    return grams.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        F.xxhash64(_hashes(F.col("gram"))).alias("hash"), "gram", "items")


def _size(column: Column) -> Column:
    """Bytes of an array of strings in a row."""
    return F.aggregate(column, F.lit(32).cast("bigint"), lambda a, w: a + F.octet_length(w) + 16)


def _hits(docs: DataFrame, benchmark: DataFrame, n: int, keys: tuple, limit: int) -> tuple[DataFrame, DataFrame]:
    """(per, sets): per document rid, keys as k_*, n_words, hits and the numbers of the item sets hit; and the sets
    (set, items).  Windows with the same items share one set, so a hit carries a number, however many items."""
    grams = checkpoint(benchmark_windows(benchmark, n))
    sets = checkpoint(grams.select("items").distinct().select(F.monotonically_increasing_id().alias("set"), "items"))
    table = checkpoint(grams.join(sets.withColumnRenamed("items", "s_items"), F.col("items") == F.col("s_items"))
                       .select(F.col("hash").alias("g_hash"), F.col("gram").alias("g_gram"), "set"))
    lengths = sorted(r[0] for r in table.select(F.size("g_gram")).distinct().collect())     # at most n values
    held = table.agg(F.sum(_size(F.col("g_gram")) + 64)).first()[0] or 0
    small = held <= limit
    ids = [f"k_{k}" for k in keys]
    words = docs.select(F.monotonically_increasing_id().alias("rid"), *[F.col(k).alias(f"k_{k}") for k in keys],
                        words_of(ascii_lower(text_of())).alias("words"))
    words = words.select("rid", *ids, "words", _hashes(F.col("words")).alias("hashes"), F.size("words").cast("bigint").alias("n_words"))
    found = [_windows(F.col("words"), F.col("hashes"), k, not small) for k in lengths]
    spans = F.concat(*found) if found else _windows(F.col("words"), F.col("hashes"), n, not small)
    rows = words.select("rid", *ids, "n_words", *(["words"] if small else []), F.posexplode_outer(spans).alias("at", "w"))
    # verified word by word; a shuffled window brings its own words, not its document's
    own = F.slice("words", F.col("w.pos") + 1, F.col("w.len")) if small else F.col("w.gram")
    hits = rows.join(F.broadcast(table) if small else table, all_of([F.col("w.hash") == F.col("g_hash"), own == F.col("g_gram")]), "left")
    # one row stays for a document without hits
    hits = hits.where(any_of([F.col("g_hash").isNotNull(), F.col("at").isNull(), F.col("at") == 0]))
    per = hits.select("rid", *ids, "n_words", "set", F.when(F.col("g_hash").isNotNull(), F.struct("w.pos", "w.len")).alias("hit"))
    return per.groupBy("rid", *ids, "n_words").agg(F.collect_set("hit").alias("hits"), F.collect_set("set").alias("sets")), sets


def _places() -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - 1)))))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, keys: tuple = ("doc_id",),
                  limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: ``keys``, n_words, hit (sorted word places inside any occurrence), items (sorted ids).

    Null and wordless texts have no words and no hits; repeated rows are documents of their own; a text of any
    length is one row with linearly many windows; a place inside several occurrences counts once, and ids are
    told apart as strings; an empty benchmark has no windows, an empty table gives no rows; of extra columns only
    ``keys`` are read.  Windows of more than ``limit`` bytes are joined by a shuffle, with the same result.
    """
    per, sets = _hits(docs, benchmark, n, keys, limit)
    per = checkpoint(per)
    some = per.where(F.size("sets") > 0).select(F.col("rid").alias("i_rid"), F.explode("sets").alias("i_set"))
    bytes_ = sets.agg(F.sum(_size(F.col("items")))).first()[0] or 0
    items = some.join(F.broadcast(sets) if bytes_ <= limit else sets, F.col("i_set") == F.col("set")).groupBy("i_rid").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return per.join(items, F.col("rid") == F.col("i_rid"), "left").select(
        *[F.col(f"k_{k}").alias(k) for k in keys], "n_words", _places().alias("hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the words hit and what stands
    between them and the word before.  The report is joined back on (doc_id, hash of the text): rows that
    agree in both get the same decision.  Columns of any name pass through."""
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    names = docs.columns
    plain = docs.toDF(*[f"c_{i}" for i in range(len(names))])
    at = {c: f"c_{i}" for i, c in enumerate(names)}
    text = F.col(at["text"])
    keyed = plain.withColumns({"key_id": F.col(at["doc_id"]), "key_h": F.xxhash64(text_of(text))})
    per, _ = _hits(keyed.select("key_id", "key_h", text.alias("text")), benchmark, n, ("key_id", "key_h"), BROADCAST_BYTES)
    bad = checkpoint(per.where(F.size("hits") > 0).select(F.col("k_key_id").alias("bad_id"), F.col("k_key_h").alias("bad_h"), _places().alias("hit"))
                     .dropDuplicates(["bad_id", "bad_h"]))
    same = all_of([F.col("key_h") == F.col("bad_h"), F.col("key_id").eqNullSafe(F.col("bad_id"))])
    if remove == "documents":
        return keyed.join(bad, same, "left_anti").select(*[F.col(at[c]).alias(c) for c in names])
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.array_contains("hit", i))
    cleaned = F.concat(F.array_join(kept, ""), F.regexp_extract(text, TAIL, 0))
    out = keyed.join(bad, same, "left").withColumn("cleaned", F.when(F.col("hit").isNotNull(), cleaned).otherwise(text))
    return out.select(*[F.col("cleaned" if c == "text" else at[c]).alias(c) for c in names])


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report on all documents against all benchmark items."""
    out = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", F.size("hit").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"))
