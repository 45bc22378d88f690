"""Static binary-fuse filters over 64-bit keys, built and asked in NumPy.

A filter of ``n`` keys is an array of about ``1.13 n`` one-byte fingerprints cut into equal segments. A key has one place in each
of three neighbouring segments, and the fingerprints there, xor-ed, are the key's own. Members are always found; other keys are
with probability 1/256. Building peels, round by round, all keys that are alone in one of their places; should some
remain, the next seed is tried. A filter never changes.
"""

from __future__ import annotations

import numpy as np

from .words import mix

_TURN = np.uint64(0x9E3779B97F4A7C15)
_HEADER = 4  # seed, number of segments, segment length, number of keys: 8 bytes each


def _places(keys: np.ndarray, seed: int, segments: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The three places of every key, and its fingerprint."""
    h = mix(keys + np.uint64(seed) * _TURN)
    # The high half picks the segment, the low half the offset in it; the other two come from fresh bits.
    first = ((h >> np.uint64(32)) * np.uint64(segments - 2)) >> np.uint64(32)
    second, third = mix(h ^ np.uint64(1)), mix(h ^ np.uint64(2))
    inside = np.stack([h, second, third]) & np.uint64(length - 1)
    at = (first + np.arange(3, dtype=np.uint64)[:, None]) * np.uint64(length) + inside
    return at.astype(np.int64), (second >> np.uint64(56)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of ``keys`` (uint64, repeats allowed) as bytes."""
    keys = np.unique(keys)
    n = len(keys)
    length = 1 << max(int(np.log(max(n, 2)) / np.log(3.33) + 1.25), 2)
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(int(np.ceil(n * factor / length)), 1) + 2
    seed = 0
    while True:
        at, print_ = _places(keys, seed, segments, length)
        rounds = _peel(at, segments * length)
        if rounds is not None:
            break
        seed += 1
        segments += seed // 8  # a little more room after several seeds
    table = np.zeros(segments * length, np.uint8)
    for key, place in reversed(rounds):
        # Places freed in one round belong to different keys, none of which touches another's.
        table[place] = print_[key] ^ table[at[0, key]] ^ table[at[1, key]] ^ table[at[2, key]]
    return np.array([seed, segments, length, n], np.int64).tobytes() + table.tobytes()


def _peel(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Keys in the order in which they are alone in a place, with that place; None when some never are."""
    n = at.shape[1]
    count = np.bincount(at.ravel(), minlength=size)
    # The sum of the numbers of the keys at a place names the key once it is alone.
    names = np.zeros(size, np.int64)
    for row in at:
        np.add.at(names, row, np.arange(n))
    rounds, left, alone = [], n, np.flatnonzero(count == 1)
    while len(alone):
        keys, where = np.unique(names[alone], return_index=True)
        rounds.append((keys, alone[where]))
        left -= len(keys)
        touched = at[:, keys].ravel()
        np.subtract.at(count, touched, 1)
        np.subtract.at(names, touched, np.tile(keys, 3))
        alone = np.unique(touched[count[touched] == 1])
    return rounds if left == 0 else None


def contains(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be a member; never False for one that is."""
    seed, segments, length, n = np.frombuffer(filter_, np.int64, _HEADER).tolist()
    if n == 0:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(filter_, np.uint8, offset=8 * _HEADER)
    at, print_ = _places(keys, seed, segments, length)
    return (table[at[0]] ^ table[at[1]] ^ table[at[2]]) == print_
