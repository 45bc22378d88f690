"""Code points of texts in Arrow batches, lower-cased, with their letters marked."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from .words import chunks

_LIMIT = 1 << 16


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For code points below 2**16: the lower-case form (of one code point), and whether it is a letter."""
    lower = np.arange(_LIMIT, dtype=np.uint32)
    letter = np.zeros(_LIMIT, bool)
    for c in range(_LIMIT):
        if 0xD800 <= c < 0xE000:
            continue
        s = chr(c)
        letter[c] = s.isalpha()
        if letter[c] and len(s.lower()) == 1:
            lower[c] = ord(s.lower())
    return lower, letter


@dataclass
class Letters:
    """Code points of consecutive texts: text ``first + k`` is ``points[bounds[k]:bounds[k + 1]]``."""

    first: int
    bounds: np.ndarray
    points: np.ndarray
    letter: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))


def letters(texts: pa.Array, size: int = 1 << 20, most: int = 1 << 30) -> Iterator[Letters]:
    lower, is_letter = _tables()
    for first, data, at in chunks(texts, size, most):
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        heads = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=heads[1:])  # code points begin at other than continuation bytes
        bounds = heads[at]
        low = np.minimum(points, _LIMIT - 1)
        letter = is_letter[low]
        far = points >= _LIMIT
        points = np.where(far, points, lower[low])
        if far.any():
            for c in np.unique(points[far]):
                letter[points == c] = chr(c).isalpha()
        yield Letters(first, bounds, points, letter)
