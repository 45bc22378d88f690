"""Word n-grams of Arrow batches, interned in an open-addressed NumPy table.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased: ASCII digits and letters, and all
characters beyond ASCII. The words of a piece of text are laid out with one blank between them, so a word and a pair of
neighbours are both one span of bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from .words import chunks

PIECE = 1 << 20  # bytes handled at a time
# For each byte its folded form, or 0 where it separates words.
_FOLD = np.zeros(256, np.uint8)
_FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)

# The five multipliers of the public xxHash64 definition.
_P1 = np.uint64(11400714785074694791)
_P2 = np.uint64(14029467366897019727)
_P3 = np.uint64(1609587929392839161)
_P4 = np.uint64(9650029242287828579)
_P5 = np.uint64(2870177450012600261)
# Spans below this length are hashed as arrays; the definition treats longer ones differently.
_STRIPE = 32


@dataclass
class Grams:
    """Spans ``data[starts:starts + lengths]``, one for each n-gram, and the row of the batch that each is of.

    ``words`` has for each of the rows ``first, first + 1, ...`` the number of its words in this piece.
    """

    first: int
    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    words: np.ndarray


def _find(data: np.ndarray, begin: int, word: bool) -> int:
    """First place from ``begin`` on that is in a word, or that is in none."""
    for at in range(begin, len(data), 1 << 16):
        hit = np.flatnonzero((_FOLD[data[at : at + (1 << 16)]] != 0) == word)
        if len(hit):
            return at + int(hit[0])
    return len(data)


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """First row, bytes and row bounds of pieces of whole texts, or of parts of one long text.

    Parts end between words. A part but the last also holds the next part's first word, for the pair across the cut, and
    is marked by ``True``.
    """
    for first, data, at in chunks(texts, size):
        if len(at) > 2 or len(data) <= 2 * size:
            yield first, data, at, False
            continue
        begin = 0
        while begin < len(data):
            end = _find(data, min(begin + size, len(data)), False)
            following = _find(data, end, True)
            if following == len(data):
                yield first, data[begin:end], np.array([0, end - begin]), False
                break
            stop = _find(data, following, False)
            yield first, data[begin:stop], np.array([0, stop - begin]), True
            begin = following


def grams(texts: pa.Array, size: int = PIECE) -> Iterator[Grams]:
    """The words and the pairs of neighbouring words of every text, a piece at a time; null counts as empty."""
    for first, raw, at, overlaps in pieces(texts, size):
        folded = _FOLD[raw]
        filled = folded != 0
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True
        opens, closes = filled.copy(), filled.copy()
        if len(raw):
            opens[1:] &= ~filled[:-1] | edge[1:-1]
            closes[:-1] &= ~filled[1:] | edge[1:-1]
        starts = np.flatnonzero(opens)
        lengths = np.flatnonzero(closes) + 1 - starts
        owner = np.searchsorted(at, starts, "right") - 1
        laid = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths + 1, out=laid[1:])
        # Eight spare bytes, so that a word of eight may be read at any place.
        data = np.full(laid[-1] + 8, 32, np.uint8)
        data[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(starts)), lengths)] = folded[filled]
        paired = np.flatnonzero(owner[1:] == owner[:-1])
        own = len(starts) - 1 if overlaps else len(starts)
        yield Grams(
            first,
            data,
            np.concatenate([laid[:own], laid[paired]]),
            np.concatenate([lengths[:own], lengths[paired] + 1 + lengths[paired + 1]]),
            np.concatenate([owner[:own], owner[paired]]),
            np.bincount(owner[:own], minlength=len(at) - 1),
        )


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _lanes(data: np.ndarray, kind: type) -> np.ndarray:
    """A view with the number of ``kind`` that begins at each byte."""
    return np.ndarray((len(data) - 7,), kind, data, 0, (1,))


def xxhash64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of spans of ``data``, which ends in eight spare bytes."""
    eight, four = _lanes(data, np.uint64), _lanes(data, np.uint32)
    h = _P5 + lengths.astype(np.uint64)
    short = lengths < _STRIPE
    for lane in range(_STRIPE // 8 - 1):
        of = np.flatnonzero(short & (lengths >= 8 * lane + 8))
        k = _turn(eight[starts[of] + 8 * lane] * _P2, 31) * _P1
        h[of] = _turn(h[of] ^ k, 27) * _P1 + _P4
    at, left = starts + (lengths & ~7), lengths & 7
    of = np.flatnonzero(short & (left >= 4))
    h[of] = _turn(h[of] ^ (four[at[of]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at, left = at + (left & 4), left & 3
    for byte in range(3):
        of = np.flatnonzero(short & (left > byte))
        h[of] = _turn(h[of] ^ (data[at[of] + byte].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    view = memoryview(data)
    for i in np.flatnonzero(~short).tolist():
        h[i] = xxhash.xxh64_intdigest(view[starts[i] : starts[i] + lengths[i]])
    return h


class Table:
    """The distinct n-grams of a piece: an open-addressed table with linear probing.

    ``slot`` has the slot of every occurrence; ``used`` the slots in use; ``count`` and ``bucket`` are arrays over slots.
    Keys are 64-bit hashes, and two spans share a slot only when their bytes are the same.
    """

    def __init__(self, found: Grams, buckets: int, keys: np.ndarray | None = None):
        self.found = found
        n = len(found.starts)
        self.keys = xxhash64(found.data, found.starts, found.lengths) if keys is None else keys
        size = 1 << max(2 * n - 1, 1).bit_length()
        holder = np.full(size, -1, np.int64)  # the occurrence that a slot stands for
        self.slot = np.zeros(n, np.int64)
        todo = np.arange(n)
        at = (self.keys & np.uint64(size - 1)).astype(np.int64)
        while len(todo):
            free = holder[at] < 0
            holder[at[free]] = todo[free]  # of several, one remains; equal keys probe in step
            same = self._same(holder[at], todo)
            self.slot[todo[same]] = at[same]
            todo, at = todo[~same], (at[~same] + 1) & (size - 1)
        self.used = np.flatnonzero(holder >= 0)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        view = memoryview(found.data)
        of = holder[self.used]
        self.bucket[self.used] = [
            zlib.crc32(view[a:b]) % buckets for a, b in zip(found.starts[of].tolist(), (found.starts[of] + found.lengths[of]).tolist(), strict=True)
        ]

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether occurrences ``a`` and ``b`` have equal keys and bytes."""
        starts, lengths, data = self.found.starts, self.found.lengths, self.found.data
        same = (a == b) | ((self.keys[a] == self.keys[b]) & (lengths[a] == lengths[b]))
        of = np.flatnonzero(same & (a != b))
        eight = _lanes(data, np.uint64)
        for lane in range(_STRIPE // 8):
            left = lengths[a[of]] - 8 * lane
            of, left = of[left > 0], left[left > 0]
            if not len(of):
                return same
            differ = eight[starts[a[of]] + 8 * lane] ^ eight[starts[b[of]] + 8 * lane]
            spare = np.uint64(8) * np.maximum(8 - left, 0).astype(np.uint64)
            equal = (differ << spare) == 0
            same[of[~equal]] = False
            of = of[equal]
        view = memoryview(data)
        for i in of[lengths[a[of]] > _STRIPE].tolist():
            x, y, n = starts[a[i]], starts[b[i]], lengths[a[i]]
            same[i] = view[x : x + n] == view[y : y + n]
        return same
