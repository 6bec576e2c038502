"""License scan: exact set-similarity join of text blocks with license templates.

Blocks are the lines of the texts, and runs of up to ``LINES`` lines, so that a
license broken over lines is found, as sets of words.  A block contains a
template if it has at least ``THRESHOLD`` of the template's distinct words.
The texts are read once: the words of any template and the line breaks between
them are kept, and frequencies and blocks are taken from those narrow rows.
Words are ordered by how many lines of the whole corpus have them, rarest
first.  To hold ``need`` of a template's words a block must have one of its
first (size - need + 1) ones (prefix filter), at least ``need`` of the
templates' words at all (length filter), and from the first word they share on
enough of both sets must be left (positional filter).  Only words of some
template can count, so a block is cut down to those, in order.  What passes is
verified in the join condition itself, which accepts a pair only at the first
word it shares: no pair comes twice and no pair is missed.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import WORD, all_of, any_of, ascii_lower, literal_rows, load, text_of
from churnlake.session import checkpoint

# fixed phrases and their labels
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# sentences of public licenses and license notices
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
)
THRESHOLD = 0.8
LINES = 4               # lines of the longest block


def template_words(templates: tuple) -> list[tuple[str, list[str]]]:
    """(label, distinct words) of each template that has words."""
    found = [(label, sorted(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())))) for label, text in templates]
    return [(label, words) for label, words in found if words]


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _phrase_starts(words: Column, phrase: list[str]) -> Column:
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1),
                    lambda i: all_of([F.get(words, i + j) == w for j, w in enumerate(phrase)]))


def known_words(docs: DataFrame, keys: tuple, known: list[str], phrases: tuple) -> DataFrame:
    """One row per document, from the only pass over the texts: rid, keys as k_*, n_words, starts (places of the
    phrases), base_labels, and ``known``: the words of the constant set ``known`` in their order, with the line
    breaks between them, joined by spaces."""
    wanted = sorted({*known, *[w for p, _ in phrases for w in p.split()], "\n"})
    low = ascii_lower(text_of())
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), *[F.col(k).alias(f"k_{k}") for k in keys],
                       F.regexp_extract_all(low, F.lit(WORD + "|\n"), F.lit(0)).alias("tokens"))
    ids = [f"k_{k}" for k in keys]
    rows = rows.select("rid", *ids, "tokens", F.filter("tokens", lambda t: t.isin(wanted)).alias("has"))
    breaks = F.size(F.filter("has", lambda t: t == "\n"))
    # where a phrase stands, its words stand side by side among the known words too
    side = F.concat(F.lit(" "), F.array_join(F.filter("has", lambda t: t != "\n"), " "), F.lit(" "))
    rows = rows.select("rid", *ids, "tokens", (F.size("tokens") - breaks).cast("bigint").alias("n_words"),
                       F.array_join("has", " ").alias("known"), side.alias("side"))
    maybe = any_of([F.contains(F.col("side"), F.lit(f" {p} ")) for p, _ in phrases])
    none = F.array().cast("array<int>")
    rows = rows.select("rid", *ids, "n_words", "known", F.when(maybe, F.filter("tokens", lambda t: t != "\n")).otherwise(_literal([])).alias("words"))
    base = {f"p{i}": F.when(F.size("words") > 0, _phrase_starts(F.col("words"), p.split())).otherwise(none) for i, (p, _) in enumerate(phrases)}
    rows = rows.select("rid", *ids, "n_words", "known", *[c.alias(n) for n, c in base.items()])
    return rows.select(
        "rid", *ids, "n_words", F.array_sort(F.concat(none, *base)).alias("starts"),
        F.array_compact(F.array(F.lit(None).cast("string"), *[
            F.when(F.size(b) > 0, F.lit(label)) for b, (_, label) in zip(base, phrases)])).alias("base_labels"), "known")


def _lines(known: Column) -> Column:
    """The known words of each line, as arrays."""
    return F.transform(F.split(known, "\n"), lambda line: F.filter(F.split(line, " "), lambda w: w != ""))


def block_frequencies(rows: DataFrame, known: list[str]) -> dict[str, int]:
    """In how many lines of the whole corpus each of ``known`` stands (one count per word comes back)."""
    lines = rows.where("known <> ''").select(F.explode(_lines(F.col("known"))).alias("line"))
    return {r["w"]: r["n"] for r in lines.select(F.explode(F.array_distinct("line")).alias("w")).where(F.col("w").isin(known))
            .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def scan(docs: DataFrame, keys: tuple = ("doc_id",), templates: tuple = TEMPLATES, phrases: tuple = PHRASES,
         threshold: float = THRESHOLD, lines: int = LINES) -> DataFrame:
    """One row per document: ``keys``, n_words, starts (phrase places), base_labels, matches (set of
    line, lines, label, containment).

    Null and empty texts have no words and no matches; a text of any length is one row; repeated rows are
    documents of their own; words as frequent as each other are ordered by themselves; a block that holds two
    templates of one label matches once per containment; an empty table gives no rows; of extra columns only
    ``keys`` are read.  The phrases and templates are parameters and bound everything that is broadcast.
    """
    spark = docs.sparkSession
    forms = template_words(templates)
    known = sorted({w for _, ws in forms for w in ws})
    pinned = checkpoint(known_words(docs, keys, known, phrases))
    count = block_frequencies(pinned, known) if known else {}
    order = sorted(known, key=lambda w: (count.get(w, 0), w))           # rarest first
    rank = {w: i for i, w in enumerate(order)}
    rows, prefix = [], set()
    for label, ws in forms:
        ws = sorted(ws, key=rank.__getitem__)
        need = math.ceil(threshold * len(ws) - 1e-9)
        for i, w in enumerate(ws[:len(ws) - need + 1]):
            prefix.add(w)
            rows.append(F.struct(F.lit(w).alias("t_word"), F.lit(label).alias("label"), F.lit(i).alias("t_pos"),
                                 F.lit(need).alias("need"), _literal(ws).alias("t_words")))
    table = literal_rows(spark, rows, "t_word string, label string, t_pos int, need int, t_words array<string>")
    least = min((math.ceil(threshold * len(ws) - 1e-9) for _, ws in forms), default=1)

    ids = [f"k_{k}" for k in keys]
    flat_cols = ["rid", *ids, "n_words", "starts", "base_labels"]
    # only documents with a prefix word have blocks that can match
    some = F.arrays_overlap(F.split("known", " "), _literal(sorted(prefix))) if prefix else F.lit(False)
    per = pinned.select(*flat_cols, F.when(some, _lines(F.col("known"))).alias("lines"))

    def runs(n: int) -> Column:
        return F.when(F.size("lines") >= n, F.transform(F.sequence(F.lit(0), F.size("lines") - n), lambda i: F.struct(
            i.alias("line"), F.lit(n).alias("lines"),
            F.array_intersect(_literal(order), F.flatten(F.slice("lines", i + 1, n))).alias("has"))))

    blocks = [runs(n) for n in range(1, lines + 1)]
    empty = F.array().cast("array<struct<line:int,lines:int,has:array<string>>>")
    # blocks that pass the length filter, as template words in global order
    found = F.filter(F.concat(*[F.coalesce(b, empty) for b in blocks]), lambda b: F.size(b["has"]) >= least)
    per = per.select(*flat_cols, F.when(F.col("lines").isNotNull(), found).otherwise(empty).alias("blocks"))
    one = per.select(*flat_cols, F.posexplode_outer("blocks").alias("b_no", "block"))
    # a word may open a match only if a template's need is still left from it on
    opening = F.slice(F.col("block.has"), F.lit(1), F.greatest(F.size("block.has") - least + 1, F.lit(0)))
    one = one.select(*flat_cols, "b_no", "block", F.posexplode_outer(opening).alias("b_pos", "b_word"))
    shared = F.array_intersect("t_words", F.col("block.has"))
    t = F.broadcast(table)
    met = one.join(t, all_of([
        F.col("b_word") == F.col("t_word"),
        F.size("block.has") >= F.col("need"),
        F.least(F.size("t_words") - F.col("t_pos"), F.size("block.has") - F.col("b_pos")) >= F.col("need"),
        F.get(shared, F.lit(0)) == F.col("b_word"),
        F.size(shared) >= F.col("need")]), "left")
    met = met.where(any_of([F.col("label").isNotNull(), all_of([F.coalesce("b_no", F.lit(0)) == 0, F.coalesce("b_pos", F.lit(0)) == 0])]))
    match = F.when(F.col("label").isNotNull(), F.struct(
        F.col("block.line").alias("line"), F.col("block.lines").alias("lines"), "label",
        (F.size(shared).cast("double") / F.size("t_words")).alias("containment")))
    return (met.select(*flat_cols, match.alias("match")).groupBy(*flat_cols).agg(F.collect_set("match").alias("matches"))
            .select(*[F.col(f"k_{k}").alias(k) for k in keys], "n_words", "starts", "base_labels", "matches"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and templates in all documents."""
    out = scan(load(spark, sf_dir, "documents"))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
    return out.select(
        "doc_id", "n_words", F.size("starts").cast("bigint").alias("n_base"),
        F.array_min("starts").cast("bigint").alias("first_word"), F.array_max("starts").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base_labels")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.transform("matches", lambda m: m["label"]))), ",").alias("labels"),
        F.when(F.size("starts") > 0, F.lit(1.0)).otherwise(best).alias("score"))
