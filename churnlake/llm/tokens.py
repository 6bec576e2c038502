"""Words of whole batches of texts, hashed with array operations (no loop over words or texts)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_FACTOR = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.concatenate([[1], np.full((1 << 12) - 1, _FACTOR, np.uint64)]).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of strings without nulls; text i is bytes[offsets[i]:offsets[i + 1]]."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """All bits of a hash spread over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(places: np.ndarray) -> np.ndarray:
    """One odd factor per place in a word: powers up to 4,096 places, products of two beyond."""
    out = _POWERS[places & 0xFFF]
    if len(places) and int(places.max()) > 0xFFF:
        out = out * mixed((places >> 12).astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    return out


def word_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of all words, which are what stands between white space."""
    gap = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts, ends = ~gap, ~gap
    starts[1:] &= gap[:-1] | edge[1:-1]
    ends[:-1] &= gap[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hash_words(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a buffer whose bytes ``codes`` replaces; equal words have equal hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    places = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    values = codes[np.repeat(starts, sizes) + places].astype(np.uint64) + np.uint64(1)
    return mixed(np.add.reduceat(values * powers(places), first) + sizes.astype(np.uint64))


def pieces(data: np.ndarray, offsets: np.ndarray, limit: int):
    """(first text, bytes, offsets) of blocks of whole texts of about ``limit`` bytes; a longer text comes in several
    blocks, cut before white space, so no word is cut and what a task holds stays bounded."""
    at = 0
    n = len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        a, b = int(offsets[at]), int(offsets[end])
        if end == at + 1 and b - a > 2 * limit:
            while a < b:
                cut = min(b, a + limit)
                while cut < b and not SPACE[data[cut]]:
                    cut += 1
                yield at, data[a:cut], np.array([0, cut - a])
                a = cut
        else:
            yield at, data[a:b], offsets[at:end + 1] - a
        at = end
