"""Leading eigenpairs of a symmetric matrix by spectrum slicing, in NumPy.

The number of eigenvalues above a shift is the number of positive pivots of an LDLᵀ factorisation of the shifted matrix
(Sylvester's law of inertia). Bisection on these counts isolates each leading eigenvalue in an interval of its own; Rayleigh
quotient iteration, which converges cubically, finishes it; and the counts just below and above the value found certify its number.
Eigenvalues that lie close together are taken together, by inverse iteration on a block, and then sliced inside their space.
"""

from __future__ import annotations

import numpy as np

# Growth bound of Bunch and Kaufman's choice between pivots of one and of two rows.
_ALPHA = (1 + np.sqrt(17)) / 8
# Eigenvalues within this part of the largest are not told apart by single vectors, which would not be orthogonal.
_NEAR = 1e-8


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` are above ``shift``: positive pivots of LDLᵀ with symmetric pivoting.

    Pivots are taken on the largest remaining diagonal or, where that is too small, on two rows at once (Bunch and Parlett).
    """
    m = a - shift * np.eye(len(a))
    tiny = np.finfo(float).eps * max(np.abs(a).max(initial=0.0), abs(shift), np.finfo(float).tiny)
    found = 0
    while len(m):
        diagonal = np.abs(np.diagonal(m))
        p = int(diagonal.argmax())
        off = np.abs(np.tril(m, -1))
        q = int(off.argmax())
        i, j = divmod(q, len(m))
        if off[i, j] <= tiny and diagonal[p] <= tiny:
            return found  # what remains is zero to rounding: not above
        if diagonal[p] >= _ALPHA * off[i, j]:
            found += bool(m[p, p] > 0)
            rest = np.delete(np.arange(len(m)), p)
            column = m[rest, p]
            m = m[np.ix_(rest, rest)] - np.outer(column, column / m[p, p])
        else:
            pair = [i, j]
            block = m[np.ix_(pair, pair)]
            found += 1  # such a block is indefinite: one pivot above zero, one below
            rest = np.delete(np.arange(len(m)), pair)
            columns = m[np.ix_(rest, pair)]
            m = m[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
            m = (m + m.T) / 2
    return found


def _solve(a: np.ndarray, shift: float, b: np.ndarray, scale: float) -> np.ndarray:
    """A solution of ``(a - shift) x = b``; an exactly singular matrix is moved by a rounding error."""
    eye = np.eye(len(a))
    step = 4 * np.finfo(float).eps * scale
    while True:
        try:
            x = np.linalg.solve(a - shift * eye, b)
            if np.isfinite(x).all():
                return x
        except np.linalg.LinAlgError:
            pass
        shift, step = shift + step, 2 * step


def _rayleigh(a: np.ndarray, start: np.ndarray, shift: float, scale: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration after two steps of inverse iteration at ``shift``."""
    v = start / np.linalg.norm(start)
    for _ in range(2):
        v = _solve(a, shift, v, scale)
        v /= np.linalg.norm(v)
    value = float(v @ a @ v)
    for _ in range(20):
        w = _solve(a, value, v, scale)
        w /= np.linalg.norm(w)
        after = float(w @ a @ w)
        done = abs(after - value) <= 2 * np.finfo(float).eps * scale and abs(abs(w @ v) - 1) < 1e-14
        v, value = w, after
        if done:
            break
    return value, v


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    The sign makes each vector's largest entry positive.
    """
    a = np.asarray(a, float)
    a = (a + a.T) / 2
    d = len(a)
    k = min(k, d)
    if not a.any():
        return np.zeros(k), np.eye(d)[:, :k]
    a, size = a / np.abs(a).max(), float(np.abs(a).max())
    radius = np.abs(a).sum(1) - np.abs(np.diagonal(a))
    low, high = float((np.diagonal(a) - radius).min(initial=0.0)), float((np.diagonal(a) + radius).max(initial=0.0))
    scale = max(abs(low), abs(high))
    slack = 64 * d * np.finfo(float).eps * scale
    low, high = low - slack, high + slack
    counts = {low: d, high: 0}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(a, shift)
        return counts[shift]

    rng = np.random.default_rng(0)
    near = _NEAR * scale
    values, vectors = np.zeros(0), np.zeros((d, 0))
    while len(values) < k:
        number = len(values) + 1
        # The tightest known bracket of this eigenvalue, narrowed until it is alone or close to the others.
        lo = max(s for s, c in counts.items() if c >= number)
        hi = min(s for s, c in counts.items() if c < number)
        while count(lo) - count(hi) > 1 and hi - lo > near:
            middle = (lo + hi) / 2
            lo, hi = (middle, hi) if count(middle) >= number else (lo, middle)
        value, v = (hi, None) if count(lo) - count(hi) > 1 else _isolated(a, lo, hi, number, count, rng, scale, slack)
        # Others so close below that their vectors could mix are taken with it, up to the next clear gap.
        width = near
        while count(value - width) < count(value - 4 * width) and width < scale:
            width *= 4
        together = count(value - width) - number + 1
        if v is None or together > 1:
            found, v = _cluster(a, value - width / 2, together, vectors, rng, scale)
        else:
            found, v = np.array([value]), v[:, None]
        for _ in range(2):
            v = v - vectors @ (vectors.T @ v)
        values = np.concatenate([values, found])
        vectors = np.concatenate([vectors, v / np.linalg.norm(v, axis=0)], axis=1)
    vectors = vectors[:, :k]
    largest = np.abs(vectors).argmax(0) if d else np.zeros(0, int)
    signs = np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return values[:k] * size, vectors * signs


def _isolated(a, lo, hi, number, count, rng, scale, slack) -> tuple[float, np.ndarray]:
    """The one eigenpair between ``lo`` and ``hi``; its number is certified by counts on both sides."""
    while True:
        value, v = _rayleigh(a, rng.standard_normal(len(a)), (lo + hi) / 2, scale)
        if lo - slack <= value <= hi + slack and count(value - slack) >= number > count(value + slack):
            return value, v
        if hi - lo <= slack:
            return value, v  # the interval is as narrow as rounding: its count is the certificate
        middle = (lo + hi) / 2  # the iteration left the interval: halve it
        lo, hi = (middle, hi) if count(middle) >= number else (lo, middle)


def _cluster(a, shift, size, known, rng, scale) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` eigenpairs around ``shift``, whose values are close together.

    Inverse iteration on a block finds their space; inside it, without what they have in common, the values are far apart
    again and are sliced in turn.
    """
    block = rng.standard_normal((len(a), size))
    for _ in range(24):
        block = _solve(a, shift, block, scale)
        block /= np.linalg.norm(block, axis=0)
        block -= known @ (known.T @ block)
        block = np.linalg.qr(block)[0]
    inner = block.T @ a @ block
    middle = float(np.trace(inner)) / size
    inner = inner - middle * np.eye(size)
    if np.abs(inner).max() <= 64 * np.finfo(float).eps * scale:
        return np.full(size, middle), block  # equal to rounding: any basis will do
    values, turn = leading(inner, size)
    return values + middle, block @ turn
