"""Words of texts: native expressions, and a vectorised tokeniser for Arrow batches.

A word is a run of ``[^\\x20\\x09-\\x0D]``: only the six ASCII blanks separate words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """The words of consecutive texts of a batch.

    ``hashes`` has one 64-bit hash a word; words of text ``first + k`` are ``bounds[k]:bounds[k + 1]``;
    word ``i`` lies at ``data[starts[i]:ends[i]]``.
    """

    first: int
    bounds: np.ndarray
    hashes: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def owner(self) -> np.ndarray:
        """For each word the number of its text within this chunk."""
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))


def chunks(texts: pa.Array, size: int = 1 << 20, most: int = 1 << 30) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a string array: first row, bytes, and bounds of the rows in them.

    A piece has whole texts, ``most`` of them and ``size`` bytes together, or one longer text. Null counts as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, min(row + most, int(np.searchsorted(at, at[row] + size, "right")) - 1))
        yield row, data[at[row] : at[last]], at[row : last + 1] - at[row]
        row = last


def tokenise(texts: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of every text, a chunk at a time; ``lower`` folds A-Z. No Python object per word."""
    for first, data, at in chunks(texts):
        if lower:
            data = _LOWER[data]
        filled = ~_BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0] = after[-1] = True
            before[1:] = ~filled[:-1] | edge[1:-1]
            after[:-1] = ~filled[1:] | edge[1:-1]
        starts = np.flatnonzero(filled & before)
        ends = np.flatnonzero(filled & after) + 1
        if len(starts):
            lead = starts[0]
            place = np.arange(lead, len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
            longest = int((ends - starts).max())
            place = np.minimum(place, longest)  # blanks after a word; they count as zero
            terms = (data[lead:].astype(np.uint64) + np.uint64(1)) * powers(_BASE, longest + 1)[place]
            terms[~filled[lead:]] = 0
            hashes = mix(np.add.reduceat(terms, starts - lead) + (ends - starts).astype(np.uint64))
        else:
            hashes = np.zeros(0, np.uint64)
        yield Words(first, np.searchsorted(starts, at), hashes, data, starts, ends)


def rolling(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of ``hashes[i:i + length]`` for each i that has so many; depends on their order."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    mixed = mix(hashes ^ np.uint64(salt)) if salt else hashes
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mixed * powers(_BASE, len(hashes)), out=total[1:])
    return mix((total[length:] - total[:-length]) * powers(_BASE_INVERSE, n))


def windows(tokens: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions in the chunk at which a window of ``length`` words of one text starts, and its text."""
    owner = tokens.owner()
    n = len(owner) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.flatnonzero(owner[:n] == owner[length - 1 :])
    return inside, owner[inside]
