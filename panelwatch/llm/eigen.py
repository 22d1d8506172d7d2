"""Leading eigenpairs of a small symmetric matrix: the numbers behind operator 13.

Householder reflections make the matrix tridiagonal, Sturm counts find its largest eigenvalues by
bisection, inverse iteration finds their vectors, and the reflections turn them back.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_CLUSTER = 1e-3  # eigenvalues closer than this part of the norm have their vectors made orthogonal


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections, one for each column but two."""
    a = np.array(matrix, float)
    size = len(a)
    reflections = []
    off = np.zeros(max(size - 1, 0))
    for j in range(size - 2):
        v = a[j + 1 :, j].copy()
        length = np.linalg.norm(v)
        off[j] = -length if v[0] > 0 else length
        v[0] -= off[j]
        scale = np.linalg.norm(v)
        v = v / scale if scale > 0 else v
        reflections.append(v)
        rest = a[j + 1 :, j + 1 :]
        p = 2 * (rest @ v)
        p -= (p @ v) * v
        rest -= np.outer(v, p) + np.outer(p, v)
    if size > 1:
        off[-1] = a[-1, -2]
    return a.diagonal().copy(), off, reflections


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each number, by the signs of a Sturm sequence."""
    least = np.finfo(float).tiny / _EPS
    counts = np.zeros(len(at), int)
    q = np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        counts += q < 0
    return counts


def largest(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected down to the rounding of the matrix's norm."""
    size = len(diagonal)
    reach = np.zeros(size)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    spread = max(np.abs(diagonal).max(), reach.max(), np.finfo(float).tiny)
    low = np.full(k, (diagonal - reach).min() - 2 * _EPS * spread)
    high = np.full(k, (diagonal + reach).max() + 2 * _EPS * spread)
    wanted = size - np.arange(k)  # of the i-th largest, so many lie below any number above it
    while True:
        middle = low + (high - low) / 2
        inside = (low < middle) & (middle < high) & (high - low > _EPS * _EPS * spread)
        if not inside.any():
            return middle
        above = counts_below(diagonal, off, middle) >= wanted
        high = np.where(inside & above, middle, high)
        low = np.where(inside & ~above, middle, low)


def _solve(diagonal: np.ndarray, off: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """A tridiagonal system by elimination with row exchanges; a vanishing pivot counts as `least`."""
    size = len(diagonal)
    d, x = diagonal.tolist(), right.tolist()
    upper, second, lower = [*off.tolist(), 0.0], [0.0] * size, off.tolist()
    for i in range(size - 1):
        if abs(lower[i]) > abs(d[i]):
            d[i], lower[i] = lower[i], d[i]
            upper[i], d[i + 1] = d[i + 1], upper[i]
            second[i], upper[i + 1] = upper[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(d[i]) < least:
            d[i] = least
        factor = lower[i] / d[i]
        d[i + 1] -= factor * upper[i]
        upper[i + 1] -= factor * second[i]
        x[i + 1] -= factor * x[i]
    if abs(d[-1]) < least:
        d[-1] = least
    for i in range(size - 1, -1, -1):
        x[i] -= upper[i] * x[i + 1] if i + 1 < size else 0.0
        x[i] -= second[i] * x[i + 2] if i + 2 < size else 0.0
        x[i] /= d[i]
    return np.array(x)


def _vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, as columns."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    random = np.random.default_rng(0)
    columns: list[np.ndarray] = []
    first = shifts = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > _CLUSTER * norm:
            first = i
        shifts = i - first
        # Equal eigenvalues get shifts of their own, so that no two iterations run into the same vector.
        moved = diagonal - (value - shifts * 10 * _EPS * norm)
        x = random.standard_normal(size)
        for _ in range(6):
            for c in columns[first:] * 2:
                x = x - (c @ x) * c
            x = x / np.linalg.norm(x)
            x = _solve(moved, off, x, _EPS * norm)
            x = x / np.abs(x).max()
        for c in columns[first:] * 2:
            x = x - (c @ x) * c
        columns.append(x / np.linalg.norm(x))
    return np.array(columns).T.reshape(size, len(values))


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues (fewer, if the matrix is smaller) and their unit vectors as columns."""
    size = len(matrix)
    k = min(k, size)
    scale = np.abs(matrix).max(initial=0.0)
    if not k or scale == 0:
        return np.zeros(k), np.eye(size)[:, :k]
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = largest(diagonal, off, k)
    vectors = _vectors(diagonal, off, values)
    for j in range(len(reflections) - 1, -1, -1):
        v = reflections[j]
        vectors[j + 1 :] -= 2 * np.outer(v, v @ vectors[j + 1 :])
    return values * scale, vectors
