"""Vectorised text primitives over Arrow string batches (numpy, no per-word loops).

Texts are UTF-8 bytes. A word is a maximal run of bytes outside the separators
0x20 and 0x09-0x0D, after lower-casing A-Z; because the separators are ASCII,
cutting bytes is the same as cutting code points. All hashes are 64 bits wide.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer single text is handled alone.
SLICE_BYTES = 1 << 21

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_SEED = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _PRIME, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string or binary array; nulls are empty."""
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    if col.null_count:
        empty = pa.scalar("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"", col.type)
        col = col.fill_null(empty)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return offsets - lo, raw[lo:hi]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes together."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _IS_SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of each word of the texts ``data[offsets[i]:offsets[i+1]]``; a byte
    for which ``separators`` is true is in no word."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~separators[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True  # a text begins: a word can't run across
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, start, end


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's lower-cased bytes (a polynomial read off
    prefix sums, then finalised together with the length)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    n = len(data)
    power = _powers(n + 1)
    acc = np.empty(n + 1, dtype=np.uint64)
    acc[0] = 0
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * power[:n], out=acc[1:])
    # sum b_j P^(j) over the word, brought to the common exponent n by P^(n - start)
    poly = (acc[end] - acc[start]) * power[n - start]
    # the exponent n is the same for all words of one call only: divide it out
    inverse = np.uint64(pow(pow(int(_PRIME), n, 1 << 64), -1, 1 << 64))
    poly = poly * inverse
    return mix64(poly ^ mix64((end - start).astype(np.uint64) + _SEED))


def shingle_hashes(row: np.ndarray, hashes: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``width`` words of a row; a row with fewer
    words gives its whole sequence as one. Not yet distinct."""
    count = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
    begin = np.concatenate(([0], np.cumsum(count)[:-1])) if n_rows else np.zeros(0, np.int64)
    odd = _powers(width + 1)[1:] | np.uint64(1)
    out_row, out_hash = [], []
    if len(hashes) >= width:
        m = len(hashes) - width + 1
        whole = row[:m] == row[width - 1 :]
        at = np.flatnonzero(whole)
        h = np.zeros(len(at), np.uint64)
        for i in range(width):
            h = mix64(h + hashes[at + i] * odd[i])
        out_row.append(row[at])
        out_hash.append(h)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        h = np.full(len(short), np.uint64(width + 1))
        for i in range(width - 1):
            has = count[short] > i
            h[has] = mix64(h[has] + hashes[begin[short[has]] + i] * odd[i] + np.uint64(i))
        out_row.append(short)
        out_hash.append(h)
    if not out_row:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_row), np.concatenate(out_hash)


def distinct_sorted(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted by row, then value (unsigned)."""
    if not len(row):
        return row, value
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[keep], value[keep]


def shingle_sets(col: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of a text column: (first row, rows, bounds, values); the set of
    row i of the slice is ``values[bounds[i]:bounds[i + 1]]``, ascending."""
    offsets, data = buffers(col)
    for i, j in slices(offsets):
        off = offsets[i : j + 1] - offsets[i]
        part = data[offsets[i] : offsets[j]]
        row, start, end = words(part, off)
        row, value = shingle_hashes(row, word_hashes(part, start, end), j - i, width)
        row, value = distinct_sorted(row, value)
        yield i, j - i, np.searchsorted(row, np.arange(j - i + 1)), value


def _letter_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the code points below 0x10000: is it a letter or a mark inside a word; is it that or
    a digit; its lower case where that is a single code point, itself otherwise."""
    letter, digit, lower = np.zeros(0x10000, bool), np.zeros(0x10000, bool), np.arange(0x10000, dtype=np.uint32)
    for c in range(0x10000):
        s = chr(c)
        digit[c] = s.isalnum()
        letter[c] = s.isalpha() or unicodedata.category(s)[0] == "M"
        small = s.lower()
        if (letter[c] or digit[c]) and len(small) == 1:
            lower[c] = ord(small)
    return letter, letter | digit, lower


_LETTER, _LETTER_OR_DIGIT, _SMALL = _letter_tables()


def letter_stream(data: np.ndarray, offsets: np.ndarray, digits: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, lower-cased, each run of other characters than letters
    (with ``digits``: than letters and digits) as one space, and each text between two
    spaces; and the bounds of the texts. Case is left as it is from 0x10000 on."""
    n = len(offsets) - 1
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    starts = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with each byte
    if len(data) and starts[-1] != len(points):  # not UTF-8 throughout: repair each text
        fixed = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return letter_stream(np.frombuffer(b"".join(fixed), np.uint8), np.cumsum([0, *map(len, fixed)]), digits)
    at = np.where(offsets > 0, starts[np.maximum(offsets, 1) - 1], 0) if len(data) else np.zeros(n + 1, np.int64)
    low = np.minimum(points, 0xFFFF)
    point = np.where((_LETTER_OR_DIGIT if digits else _LETTER)[low], _SMALL[low], np.uint32(32))
    high = np.flatnonzero(points > 0xFFFF)
    for c in np.unique(points[high]):
        if chr(c).isalnum() if digits else chr(c).isalpha():
            point[high[points[high] == c]] = c
    # a space before and after each text
    bounds = np.concatenate((at[:-1], at[1:]))
    order = np.argsort(np.concatenate((np.arange(n) * 2, np.arange(n) * 2 + 1)), kind="stable")
    point = np.insert(point, bounds[order], np.uint32(32))
    begin = at[:-1] + 2 * np.arange(n)
    end = at[1:] + 2 * np.arange(n) + 2
    keep = np.ones(len(point), bool)
    keep[1:] = (point[1:] != 32) | (point[:-1] != 32)
    keep[begin] = True
    at_most = np.concatenate(([0], np.cumsum(keep)))
    bounds = np.append(at_most[begin], at_most[-1]) if n else np.zeros(1, np.int64)
    return point[keep], bounds


def gram_hashes(points: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` code points (texts aren't told apart)."""
    m = len(points) - width + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    wide = points.astype(np.uint64)
    total = np.full(m, np.uint64(width), np.uint64)
    factor = int(_PRIME)
    for i in range(width):
        total += wide[i : i + m] * np.uint64(factor)
        factor = factor * int(_PRIME) % (1 << 64)
    return mix64(total)


class Lookup:
    """Finds which of many hashes belong to a small fixed set: a bitmap of their top
    bits rules most out, a binary search settles the rest."""

    BITS = 22

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self._map = None

    def __getstate__(self):
        return {"hashes": self.hashes, "_map": None}

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``hashes``, index in the sorted set) of each hit."""
        if not len(self.hashes) or not len(hashes):
            z = np.zeros(0, np.int64)
            return z, z
        shift = np.uint64(64 - self.BITS)
        if self._map is None:
            self._map = np.zeros(1 << self.BITS, bool)
            self._map[self.hashes >> shift] = True
        at = np.flatnonzero(self._map[hashes >> shift])
        index = np.searchsorted(self.hashes, hashes[at])
        hit = self.hashes[np.minimum(index, len(self.hashes) - 1)] == hashes[at]
        return at[hit], index[hit]
