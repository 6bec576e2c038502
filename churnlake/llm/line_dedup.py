"""Removal of repeated runs by winnowing over line hashes.

A text is a sequence of units: its lines, cut at sentence ends, without empty
ones.  A gram is a shortest run of units with ``GRAM_WORDS`` words; of the
grams inside each shortest run with ``SURE_WORDS`` words the one with the
smallest hash is a fingerprint.  So two texts that share a run of
``SURE_WORDS`` words share a fingerprint in it, and no match of fewer than
``GRAM_WORDS`` words is ever made.  Fingerprints are joined with their first
place in the corpus (by doc_id, null ids last, then place), verified, extended
unit by unit both ways, and what is found is removed from the later text.

Passages whose edges lie inside units are found by the same method over words:
grams of ``GRAM_WORDS`` words, winnowed in each run of ``SURE_WORDS`` words and
extended word by word.  Only the texts of a pair are read again for that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import all_of, broadcast_if_small, load, stored, text_of
from churnlake.llm.tokens import LOWER, buffers, hash_words, mixed, word_table
from churnlake.session import checkpoint

GRAM_WORDS = 25
SURE_WORDS = 50
HOT_PAIRS = 256         # pairs of one source that one task may hold
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_TOGETHER = 1 << 21     # bytes of whole texts that are taken in one go
_CELLS = 1 << 20        # values compared in one go
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True


def _powers(factor: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), factor, np.uint64)]))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run values[start:end], the same wherever the run stands: differences of prefix sums."""
    n = len(values) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_FACTOR, n)[:-1], dtype=np.uint64)])
    return mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts])


def unit_table(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The words and the non-empty units of a block of texts, as flat arrays.

    Units are lines, cut after . ! ? before white space.  ``word``: hashes of all words (A-Z lower-cased),
    ``word_row``: their text; of each unit ``row``, ``hash``, ``words``, and ``start``, ``end`` in characters.
    """
    starts, ends, row = word_table(data, offsets)
    word = hash_words(LOWER[data], starts, ends)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return {"word": word, "word_row": none, "row": none, "hash": word, "words": none, "start": none, "end": none}
    breaks = np.flatnonzero(data == 10)
    line = np.repeat(np.arange(len(breaks) + 1), np.diff(np.searchsorted(starts, breaks), prepend=0, append=len(starts)))  # breaks before the word
    text_start, text_end = offsets[row], offsets[row + 1]
    new_line = np.ones(len(starts), bool)
    new_line[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
    last = np.append(new_line[1:], True)
    stop = _STOPS[data[ends - 1]] & (ends < text_end) & (data[np.minimum(ends, len(data) - 1)] != 10)
    at = np.flatnonzero(last | stop)
    first = np.concatenate([[0], at[:-1] + 1])
    around = np.concatenate([[-1], breaks, [len(data)]])
    start = np.where(new_line[first], np.maximum(text_start[first], around[line[first]] + 1), ends[first - 1])
    end = np.where(stop[at], ends[at], np.minimum(text_end[at], around[line[at] + 1]))
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return {"word": word, "word_row": row, "row": row[at], "hash": run_hashes(word, first, at + 1), "words": at + 1 - first,
            "start": chars[start] - chars[text_start[at]], "end": chars[end] - chars[text_start[at]]}


def _later(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two places the one with the smaller value, the later one of equal ones."""
    return np.where(values[a] == values[b], np.maximum(a, b), np.where(values[b] < values[a], b, a))


def smallest_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the smallest value in each values[first:last + 1], the last one of equal ones."""
    if not len(first):
        return np.zeros(0, np.int64)
    level = np.floor(np.log2(last - first + 1)).astype(np.int64)
    out, at, size = np.zeros(len(first), np.int64), np.arange(len(values)), 1
    for k in range(int(level.max()) + 1):
        mine = level == k
        out[mine] = _later(values, at[first[mine]], at[last[mine] - size + 1])
        if size < len(at):
            at = _later(values, at[:-size], at[size:])
        size *= 2
    return out


def smallest_in_runs(values: np.ndarray, n: int) -> np.ndarray:
    """Place of the smallest value in each values[i:i + n], the last one of equal ones."""
    low, at, size = values, np.arange(len(values)), 1
    while size < n:
        step = min(size, n - size)
        low, at = np.minimum(low[:-step], low[step:]), np.where(low[step:] <= low[:-step], at[step:], at[:-step])
        size += step
    return at


def _once(places: np.ndarray) -> np.ndarray:
    """Ascending places, each once."""
    return places[np.diff(places, prepend=-1) > 0]


def unit_prints(hashes: np.ndarray, words: np.ndarray, row: np.ndarray, gram: int = GRAM_WORDS,
                sure: int = SURE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowed (hash, first unit, units) of the units of a block of texts: of the grams inside each shortest run
    with ``sure`` words the one with the smallest hash."""
    n = len(hashes)
    total = np.concatenate([[0], np.cumsum(words)])
    text_end = np.searchsorted(row, row, side="right")
    gram_end = np.searchsorted(total, total[:-1] + gram)        # end (exclusive) of the gram from each unit
    sure_end = np.searchsorted(total, total[:-1] + sure)
    at = np.flatnonzero(sure_end <= text_end)
    whole = np.flatnonzero(gram_end <= n)
    values = np.zeros(n, np.uint64)
    values[whole] = run_hashes(hashes, whole, gram_end[whole])
    last = np.searchsorted(gram_end, sure_end[at], side="right") - 1
    chosen = _once(smallest_between(values, at, last))
    return values[chosen], chosen, gram_end[chosen] - chosen


def word_prints(words: np.ndarray, row: np.ndarray, gram: int = GRAM_WORDS, sure: int = SURE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed (hash, first word) of the grams of words of a block of texts."""
    n = len(words)
    if n < sure:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(n - gram + 1)
    values = run_hashes(words, at, at + gram)
    inside = np.arange(n - sure + 1) + sure <= np.cumsum(np.bincount(row))[row[:n - sure + 1]]
    chosen = _once(smallest_in_runs(values, sure - gram + 1)[inside])
    return values[chosen], chosen


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of blocks of whole texts."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _TOGETHER, side="right")) - 1)
        yield at, end
        at = end


_PACKED = {"hashes": np.int64, "words": np.int32, "starts": np.int32, "ends": np.int32}     # one binary value per text
_LISTS = {"p_h": "bigint", "p_pos": "int", "p_n": "int", "w_h": "bigint", "w_pos": "int"}
_UNITS = {"n_units": "int", "n_words": "bigint", **{c: "binary" for c in _PACKED}, **{c: f"array<{t}>" for c, t in _LISTS.items()}}


def _cuts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])


def _list_of(values: np.ndarray | pa.Array, sizes: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.Array:
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array(_cuts(sizes), pa.int32()), values)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all values, values per row) of a list column; null rows have none."""
    return (column.flatten().to_numpy(zero_copy_only=False),
            column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(all values, place of the first of each row and the end) of a column of ``_PACKED``."""
    data, offsets = buffers(column)
    return np.frombuffer(data.tobytes(), kind), offsets // np.dtype(kind).itemsize


def _texts_of(values: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, place of the first of each row and the end) of the given rows one after the other."""
    sizes = at[rows + 1] - at[rows]
    cuts = _cuts(sizes)
    return values[np.repeat(at[rows] - cuts[:-1], sizes) + np.arange(cuts[-1])], cuts


def _text_units(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """The columns of ``_UNITS`` of a block of texts."""
    n = len(offsets) - 1
    t = unit_table(data, offsets)
    count = lambda row: np.bincount(row, minlength=n)
    units, words = count(t["row"]), count(t["word_row"])
    p_h, p_at, p_n = unit_prints(t["hash"], t["words"], t["row"])
    w_h, w_at = word_prints(t["word"], t["word_row"])
    p_row, w_row = t["row"][p_at], t["word_row"][w_at]
    held = {"hashes": t["hash"].view(np.int64), "words": t["words"], "starts": t["start"], "ends": t["end"]}
    lists = {"p_h": (p_h.view(np.int64), p_row), "p_pos": (p_at - _cuts(units)[p_row], p_row), "p_n": (p_n, p_row),
             "w_h": (w_h.view(np.int64), w_row), "w_pos": (w_at - _cuts(words)[w_row], w_row)}
    return [pa.array(units, pa.int32()), pa.array(words, pa.int64()),
            *[pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((_cuts(units) * np.dtype(kind).itemsize).astype(np.int32)),
                                                     pa.py_buffer(held[c].astype(kind))]) for c, kind in _PACKED.items()],
            *[_list_of(lists[c][0], count(lists[c][1]), pa.int64() if kind == "bigint" else pa.int32()) for c, kind in _LISTS.items()]]


def _units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text, the last column, replaced by its units and fingerprints."""
    for batch in batches:
        data, offsets = buffers(batch.column(batch.num_columns - 1))
        for a, b in _blocks(offsets):
            columns = _text_units(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([*[c.slice(a, b - a) for c in batch.columns[:-1]], *columns],
                                             names=[*batch.schema.names[:-1], *_UNITS])


def _agree(x: np.ndarray, p: np.ndarray, y: np.ndarray, q: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
    """How many values from each x[p] and y[q] on agree, at most ``most``; ``way`` -1 goes backwards."""
    out = np.zeros(len(p), np.int64)
    left, size = np.flatnonzero(most > 0), 32
    while len(left):
        size = max(1, min(size, _CELLS // len(left)))
        at = out[left, None] + np.arange(size)
        near = way * np.minimum(at, most[left, None] - 1)
        differ = (at >= most[left, None]) | (x[p[left, None] + near] != y[q[left, None] + near])
        ends = differ.any(axis=1)
        out[left] += np.where(ends, differ.argmax(axis=1), size)
        left, size = left[~ends], 2 * size
    return out


def _joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs (first, end) in ascending order, those that overlap as one."""
    order = np.argsort(a, kind="stable")
    a, ends = a[order], np.maximum.accumulate(b[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] >= ends[:-1]
    return a[new], ends[np.append(new[1:], True)[:len(a)]]


def extend(own: np.ndarray, own_at: np.ndarray, other: np.ndarray, other_at: np.ndarray, row: np.ndarray, pos: np.ndarray,
           at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, end) of maximal runs of each own[own_at[row]:own_at[row + 1]] that equal runs of ``other`` there, from
    seeds (row, pos, other pos, n); runs that overlap are one.

    All pairs together, a few seeds of each at a time: a seed inside what its pair has found is done if the values
    next to that differ for it, so a text that repeats itself is not compared anew from every place."""
    order = np.lexsort((at, pos, row))
    row, n = row[order], n[order]
    p, q = pos[order] + own_at[row], at[order] + other_at[row]
    a = b = np.zeros(0, np.int64)
    take = 1
    while len(p):
        now = np.arange(len(row)) - np.searchsorted(row, row) < take
        r, x, y, size = row[now], p[now], q[now], n[now]
        ahead = _agree(own, x, other, y, np.minimum(own_at[r + 1] - x, other_at[r + 1] - y), 1)
        same = ahead >= size
        r, x, y, ahead = r[same], x[same], y[same], ahead[same]
        back = _agree(own, x - 1, other, y - 1, np.minimum(x - own_at[r], y - other_at[r]), -1)
        a, b = _joined(np.concatenate([a, x - back]), np.concatenate([b, x + ahead]))
        row, p, q, n = row[~now], p[~now], q[~now], n[~now]
        if len(a) and len(p):
            k = np.maximum(np.searchsorted(a, p, side="right") - 1, 0)
            first, end, shift = a[k], b[k], q - p
            before = (first > own_at[row]) & (first + shift > other_at[row])
            before &= own[first - 1] == other[np.clip(first - 1 + shift, 0, len(other) - 1)]
            after = (end < own_at[row + 1]) & (end + shift < other_at[row + 1])
            after &= own[np.minimum(end, len(own) - 1)] == other[np.clip(end + shift, 0, len(other) - 1)]
            more = (first > p) | (p + n > end) | before | after
            row, p, q, n = row[more], p[more], q[more], n[more]
        take *= 4
    found = np.searchsorted(own_at, a, side="right") - 1
    return found, a - own_at[found], b - own_at[found]


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(r_rid, a, b), the runs of a pair as lists, from (rid, own, other, pos, at, n)."""
    for batch in batches:
        pos, seeds = _values(batch.column(3))
        at, n = _values(batch.column(4))[0], _values(batch.column(5))[0]
        row, a, b = extend(*_unpacked(batch.column(1), np.int64), *_unpacked(batch.column(2), np.int64),
                           np.repeat(np.arange(batch.num_rows), seeds), pos, at, n)
        runs = np.bincount(row, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), _list_of(a, runs), _list_of(b, runs)], names=["r_rid", "a", "b"])


def _words_extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w_rid, a, b, start, end), the runs of a pair as lists, from (rid, own, other, pos, at); the texts come compressed."""
    for batch in batches:
        (pos, seeds), (at, _) = _values(batch.column(3)), _values(batch.column(4))
        cuts = _cuts(seeds)
        own, other = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        first = 0
        while first < len(own):
            number: dict[bytes, int] = {}       # a text of several pairs is taken apart once
            texts, held, end = [], 0, first
            while end < len(own) and (end == first or held < _TOGETHER):
                for packed in (own[end], other[end]):
                    if number.setdefault(packed, len(texts)) == len(texts):
                        texts.append(zlib.decompress(packed))
                        held += len(texts[-1])
                held += 64 * int(cuts[end + 1] - cuts[end])
                end += 1
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = _cuts(np.array([len(t) for t in texts]))
            starts, ends, text = word_table(data, offsets)
            words = hash_words(LOWER[data], starts, ends)
            word_at = np.searchsorted(text, np.arange(len(texts) + 1))
            mine, theirs = (np.array([number[t] for t in side[first:end]]) for side in (own, other))
            some = slice(cuts[first], cuts[end])
            row, a, b = extend(*_texts_of(words, word_at, mine), *_texts_of(words, word_at, theirs),
                               np.repeat(np.arange(end - first), seeds[first:end]), pos[some], at[some],
                               np.full(cuts[end] - cuts[first], GRAM_WORDS))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            text_at, word = chars[offsets[mine[row]]], word_at[mine[row]]
            runs = np.bincount(row, minlength=end - first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, end - first), *[_list_of(v, runs) for v in (
                    a, b, chars[starts[word + a]] - text_at, chars[ends[word + b - 1]] - text_at)]],
                names=["w_rid", "w_a", "w_b", "w_start", "w_end"])
            first = end


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last nine columns (words, starts, ends of the units; a, b of repeated runs of units; a, b, start, end of repeated
    runs of words) replaced by removed, n_removed_words and spans: removed units and runs of words that overlap together."""
    for batch in batches:
        words, at = _unpacked(batch.column(batch.num_columns - 9), np.int32)
        starts, ends = (_unpacked(batch.column(batch.num_columns - k), np.int32)[0] for k in (8, 7))
        (a, sizes), (b, _) = (_values(batch.column(batch.num_columns - k)) for k in (6, 5))
        first_unit = np.repeat(at[:-1], sizes)
        marks = np.bincount(first_unit + a, minlength=len(words) + 1) - np.bincount(first_unit + b, minlength=len(words) + 1)
        unit = np.flatnonzero(np.cumsum(marks) > 0)
        unit_row = np.searchsorted(at, unit, side="right") - 1
        total = _cuts(words)
        runs = [_values(batch.column(batch.num_columns - k)) for k in (4, 3, 2, 1)]
        first_word = np.repeat(total[at[:-1]], runs[0][1])
        a = np.concatenate([total[unit], runs[0][0] + first_word])
        b = np.concatenate([total[unit + 1], runs[1][0] + first_word])
        start, end = np.concatenate([starts[unit], runs[2][0]]), np.concatenate([ends[unit], runs[3][0]])
        order = np.argsort(a, kind="stable")
        a, b = _joined(a, b)
        piece = np.searchsorted(np.concatenate([total[unit], runs[0][0] + first_word])[order], a)
        start, end = (np.minimum.reduceat(start[order], piece), np.maximum.reduceat(end[order], piece)) if len(a) else (start, end)
        row = np.searchsorted(total[at], a, side="right") - 1
        n_words = np.bincount(row, weights=b - a, minlength=batch.num_rows).astype(np.int64)
        spans = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32())], names=["start", "end"])
        count = lambda r: np.bincount(r, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-9], _list_of(unit - at[unit_row], count(unit_row)), pa.array(n_words, pa.int64()), _list_of(spans, count(row))],
            names=[*batch.schema.names[:-9], "removed", "n_removed_words", "spans"])


def _packed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: zlib.compress(t.encode("utf-8", "surrogatepass"), 1))


_WORD_RUNS = ("w_a", "w_b", "w_start", "w_end")


def _all_lists(name: str) -> Column:
    """The lists of a group one after the other, those of several columns in one order."""
    return F.flatten(F.collect_list(name)).alias(name)


def _first_places(rows: DataFrame, id_col: str, prints: tuple) -> tuple[DataFrame, DataFrame]:
    """(places, first): the fingerprints that stand at two places or more, with all their places and with the first."""
    at = rows.select(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), "rid", "t_h", "t_g",
                     F.explode(F.arrays_zip(*prints)).alias("p")).select(
        "unknown", "id", "rid", "t_h", "t_g", *[F.col(f"p.{c}").alias(c.split("_")[1]) for c in prints])
    # of all fingerprints only hash and count are shuffled
    again = checkpoint(at.groupBy(F.col("h").alias("a_h")).agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("a_h"))
    places = at.join(broadcast_if_small(again, 16), F.col("h") == F.col("a_h")).drop("a_h")
    # checkpointed, so that the join with it shuffles both sides for itself and AQE can split a hot fingerprint
    first = checkpoint(places.groupBy(F.col("h").alias("f_h")).agg(
        F.min(F.struct("unknown", "id", "rid", "pos", "t_h", "t_g")).alias("first")))
    return places, first


def _word_runs(docs: DataFrame, rows: DataFrame, keys: tuple) -> DataFrame:
    """(w_rid, lists of _WORD_RUNS): the repeated runs of words of the documents that have any."""
    places, first = _first_places(rows, keys[0], ("w_h", "w_pos"))
    seeds = places.join(first, F.col("h") == F.col("f_h")).where(
        (F.col("rid") != F.col("first.rid")) | (F.col("pos") != F.col("first.pos")))
    pairs = stored(seeds.groupBy("rid", "t_h", "t_g", F.col("first.t_h").alias("s_h"), F.col("first.t_g").alias("s_g"), F.col("first.rid").alias("src"))
                       .agg(F.collect_list(F.struct("pos", F.col("first.pos").alias("at"))).alias("seeds")), "line-pairs")
    # the texts again, by 128 bits of their hash: equal texts are held once
    asked = checkpoint(pairs.select("t_h", "t_g").union(pairs.select("s_h", "s_g")).distinct())
    texts = docs.select(F.xxhash64(text_of()).alias("x_h"), F.xxhash64(F.lit(1), text_of()).alias("x_g"), text_of().alias("x_text"))
    texts = texts.join(broadcast_if_small(asked, 32), all_of([F.col("x_h") == F.col("t_h"), F.col("x_g") == F.col("t_g")]), "left_semi")
    texts = (texts.select("x_h", "x_g", F.pandas_udf(_packed, "binary")("x_text").alias("packed"))
             .groupBy("x_h", "x_g").agg(F.first("packed").alias("packed")))
    pairs = _with_text(_with_text(pairs, texts, "t_h", "t_g", "own"), texts, "s_h", "s_g", "other")
    runs = pairs.select("rid", "own", "other", *[F.transform("seeds", _field(c)).alias(c) for c in ("pos", "at")]).mapInArrow(
        _words_extended, ", ".join(["w_rid long", *[f"{c} array<int>" for c in _WORD_RUNS]]))
    return runs.groupBy("w_rid").agg(*[_all_lists(c) for c in _WORD_RUNS])


def _with_text(pairs: DataFrame, texts: DataFrame, h: str, g: str, name: str) -> DataFrame:
    """``pairs`` with the text of hash (h, g) as ``name``.  A text of very many pairs (a passage that everyone
    repeats has one source, a text may have many copies) is replicated and its pairs are dealt out."""
    hot = checkpoint(pairs.groupBy(F.col(h).alias("o_h"), F.col(g).alias("o_g")).agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > HOT_PAIRS).select("o_h", "o_g", F.ceil(F.col("n") / HOT_PAIRS).alias("parts")))
    held = broadcast_if_small(hot, 48)
    on = lambda x, y: all_of([F.col(x) == F.col("o_h"), F.col(y) == F.col("o_g")])
    texts = texts.withColumnRenamed("packed", name)
    cold = pairs.join(held, on(h, g), "left_anti").join(texts, all_of([F.col(h) == F.col("x_h"), F.col(g) == F.col("x_g")]))
    dealt = pairs.join(held, on(h, g)).withColumn("salt", F.pmod(F.xxhash64("rid"), "parts")).drop("o_h", "o_g", "parts")
    copies = texts.join(held, on("x_h", "x_g")).select("x_h", "x_g", name, F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("x_salt"))
    warm = dealt.join(copies, all_of([F.col(h) == F.col("x_h"), F.col(g) == F.col("x_g"), F.col("salt") == F.col("x_salt")]))
    kept = [*pairs.columns, name]
    return cold.select(*kept).union(warm.select(*kept))


def _field(name: str):
    return lambda s: s[name]


def repeated_runs(docs: DataFrame, keys: tuple = ("doc_id",)) -> DataFrame:
    """One row per document: ``keys`` (the first is the id), n_units, n_words, removed (sorted places of the
    units to remove as a whole), n_removed_words, spans (start, end in characters of all that is to be removed:
    these units, and repeated runs of words that begin or end inside a unit).

    Null and empty texts have no units; of repeated rows the one read first keeps its text, and of documents
    with one id likewise; a text of any length is taken as a whole by one task; equal hashes inside a window
    choose the last gram; an empty table gives no rows; of extra columns only ``keys`` are read.
    """
    plain = docs.select(*keys, F.monotonically_increasing_id().alias("rid"), F.xxhash64(text_of()).alias("t_h"),
                        F.xxhash64(F.lit(1), text_of()).alias("t_g"), text_of().alias("text"))
    fields = lambda df: [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    rows = stored(plain.mapInArrow(_units_of, ", ".join([*fields(plain)[:-1], *[f"{c} {t}" for c, t in _UNITS.items()]])), "line-units")
    places, first = _first_places(rows, keys[0], ("p_h", "p_pos", "p_n"))
    seeds = places.join(first, F.col("h") == F.col("f_h")).where(
        (F.col("rid") != F.col("first.rid")) | (F.col("pos") != F.col("first.pos")))
    pairs = seeds.groupBy("rid", F.col("first.rid").alias("src")).agg(
        F.collect_list(F.struct("pos", F.col("first.pos").alias("at"), "n")).alias("seeds"))
    sides = rows.select(F.col("rid").alias("s_rid"), "hashes")
    pairs = pairs.join(sides.withColumnRenamed("hashes", "own"), F.col("rid") == F.col("s_rid")).drop("s_rid")
    pairs = pairs.join(sides.withColumnRenamed("hashes", "other"), F.col("src") == F.col("s_rid"))
    runs = pairs.select("rid", "own", "other", *[F.transform("seeds", _field(c)).alias(c) for c in ("pos", "at", "n")]).mapInArrow(
        _extended, "r_rid long, a array<int>, b array<int>")
    runs = runs.groupBy("r_rid").agg(_all_lists("a"), _all_lists("b"))
    kept = rows.select(*keys, "n_units", "n_words", "rid", "words", "starts", "ends")
    out = kept.join(runs, F.col("rid") == F.col("r_rid"), "left").join(_word_runs(docs, rows, keys), F.col("rid") == F.col("w_rid"), "left")
    out = out.select(*keys, "n_units", "n_words", "words", "starts", "ends", "a", "b", *_WORD_RUNS)
    return out.mapInArrow(_removed, ", ".join([
        *fields(out)[:-9], "removed array<int>", "n_removed_words bigint", "spans array<struct<start:int,end:int>>"]))


def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    def cut(t: str | None, held) -> str | None:
        for s in reversed(list(held) if held is not None else []):
            t = t[:s["start"]] + t[s["end"]:]
        return t

    return pd.Series([cut(t, s) for t, s in zip(text, spans)], dtype=object)


def drop_repeated_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated runs cut out of their texts; joined back on (doc_id, hash of the text), and
    of rows that agree in both one stays."""
    names = docs.columns
    at = {c: f"c_{i}" for i, c in enumerate(names)}
    keyed = docs.toDF(*at.values()).withColumns({"key_id": F.col(at["doc_id"]), "key_h": F.xxhash64(text_of(at["text"]))}).dropDuplicates(["key_id", "key_h"])
    found = repeated_runs(keyed.select("key_id", "key_h", F.col(at["text"]).alias("text")), ("key_id", "key_h")).where(F.size("spans") > 0).select(
        F.col("key_id").alias("r_id"), F.col("key_h").alias("r_h"), "spans")
    out = keyed.join(found, all_of([F.col("key_h") == F.col("r_h"), F.col("key_id").eqNullSafe(F.col("r_id"))]), "left")
    out = out.withColumn("cut", F.when(F.col("spans").isNull(), F.col(at["text"])).otherwise(F.pandas_udf(_cut, "string")(at["text"], "spans")))
    return out.select(*[F.col("cut" if c == "text" else at[c]).alias(c) for c in names])


def op9_winnowed_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated runs in all documents."""
    out = repeated_runs(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_units", "n_words", F.size("removed").alias("n_removed"), "n_removed_words", F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("removed_spans"))
