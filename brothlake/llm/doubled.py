"""Double-double numpy arithmetic: a number is the unevaluated sum of a high and a low part, twice as exact as a double.

Sums come from the error-free transformation of a sum of two doubles. Products
of matrices come from an error-free splitting: every factor is cut into
integers of so few bits that BLAS adds up their products without rounding, and
only the sums of those are rounded, to double-double.
"""

from __future__ import annotations

import numpy as np

#: Slices of a factor, and the bits that are exact in a double.
SLICES, EXACT_BITS = 5, 53

Pair = tuple[np.ndarray, np.ndarray]


def two_sum(a, b) -> Pair:
    """a + b rounded, and what the rounding lost."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def add(x: Pair, y: Pair) -> Pair:
    high, low = two_sum(x[0], y[0])
    other, lost = two_sum(x[1], y[1])
    high, low = two_sum(high, low + other)
    return two_sum(high, low + lost)


def minus(x: Pair) -> Pair:
    return -x[0], -x[1]


def pair(x) -> Pair:
    return np.asarray(x, float), np.zeros(np.shape(x))


def whole(x: np.ndarray) -> Pair:
    """int64 as it is."""
    return two_sum((x >> 32).astype(float) * 2.0**32, (x & 0xFFFFFFFF).astype(float))


def _slices(x: Pair, axis: int, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Integers of ``bits`` bits, most significant first, and the exponent of each row or column along ``axis``."""
    high, low = x
    top = np.frexp(np.abs(high).max(axis=axis, keepdims=True, initial=0.0))[1]
    out = []
    for k in range(1, SLICES + 1):
        part = np.rint(np.ldexp(high, k * bits - top))
        out.append(part)
        high, low = two_sum(high - np.ldexp(part, top - k * bits), low)
    return out, top


def product(a: Pair, b: Pair) -> Pair:
    """a @ b; each entry's error is about 2^-100 of the largest entries of its row and column, times the length."""
    bits = (EXACT_BITS - 1 - max(1, a[0].shape[1]).bit_length()) // 2
    left, rows = _slices(a, 1, bits)
    right, columns = _slices(b, 0, bits)
    total = pair(np.zeros((a[0].shape[0], b[0].shape[1])))
    for level in reversed(range(SLICES)):
        for p in range(level + 1):
            total = add(total, pair(np.ldexp(left[p] @ right[level - p], rows + columns - (level + 2) * bits)))
    return total


def scaled(x: Pair, factor: np.ndarray | float) -> Pair:
    """x times doubles."""
    a, b = np.broadcast_arrays(x[0], np.asarray(factor, float))
    high, lost = _two_product(a, b)
    return two_sum(high, lost + x[1] * b)


def over(x: Pair, n: float) -> Pair:
    """x divided by a double."""
    high = x[0] / n
    back, lost = _two_product(high, np.broadcast_to(np.float64(n), np.shape(high)))
    return two_sum(high, ((x[0] - back) - lost + x[1]) / n)


def _two_product(a: np.ndarray, b: np.ndarray) -> Pair:
    """a * b rounded, and what the rounding lost."""
    p = a * b
    halves = lambda v: ((c := 134217729.0 * v) - (c - v), v - (c - (c - v)))
    (ah, al), (bh, bl) = halves(a), halves(b)
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def eigen(v: Pair, rounds: int = 8) -> tuple[np.ndarray, Pair]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    The first solution is LAPACK's (Householder tridiagonalisation, then divide
    and conquer) in double. It is then improved in double-double: the vectors
    are made orthogonal, the matrix is seen from them, and what is left off its
    diagonal turns them by first-order terms, or, among eigenvalues too close
    for those, by an eigen-solve of their block alone, less its mean.
    """
    d = len(v[0])
    vectors = pair(np.linalg.eigh(v[0])[1][:, ::-1])
    for _ in range(rounds):
        vectors, seen = _seen(v, vectors)
        values = seen[0].diagonal() + seen[1].diagonal()
        apart, rest = values[None] - values[:, None], seen[0] - np.diag(seen[0].diagonal())
        blocks = _linked(np.abs(rest) > 0.01 * np.abs(apart))
        alone = np.ones((d, d), bool)
        for block in blocks:
            alone[np.ix_(block, block)] = False
        turn = np.divide(rest, apart, out=np.zeros_like(rest), where=alone & (apart != 0))
        vectors = add(vectors, product(vectors, pair(turn)))
        for block in blocks:
            inner = (seen[0][np.ix_(block, block)] - values[block].mean() * np.eye(len(block))) + seen[1][np.ix_(block, block)]
            turned = product((vectors[0][:, block], vectors[1][:, block]), pair(np.linalg.eigh(inner)[1]))
            vectors[0][:, block], vectors[1][:, block] = turned
        if not blocks and np.abs(turn).max(initial=0.0) < 2.0**-90:
            break
    vectors, seen = _seen(v, vectors)
    values = seen[0].diagonal() + seen[1].diagonal()
    order = np.argsort(-values, kind="stable")
    return values[order], (vectors[0][:, order], vectors[1][:, order])


def _seen(v: Pair, vectors: Pair) -> tuple[Pair, Pair]:
    """The vectors made orthogonal, and the matrix as seen from them."""
    for _ in range(2):
        off = add(pair(np.eye(len(v[0]))), minus(product((vectors[0].T, vectors[1].T), vectors)))
        vectors = add(vectors, product(vectors, scaled(off, 0.5)))
    return vectors, product((vectors[0].T, vectors[1].T), product(v, vectors))


def _linked(near: np.ndarray) -> list[np.ndarray]:
    """Groups of two or more indices that the matrix links."""
    group = np.arange(len(near))
    while True:
        least = np.minimum(group, np.where(near | near.T, group[None], len(near)).min(1, initial=len(near)))
        if (least == group).all():
            return [np.flatnonzero(group == g) for g in np.unique(group) if (group == g).sum() > 1]
        group = least
