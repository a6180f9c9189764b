"""Exact products of integer matrices by Strassen's recursion.

Both factors are padded with zeros until every side halves a whole number of times; a level replaces eight half-sized
products by seven and some integer additions. The smallest products are done by BLAS in doubles where a bound proves
every partial sum a whole number below 2**53, else in 64-bit integers. Integer arithmetic wraps, which is a ring, so a
product entry that fits 64 bits is right whatever its parts do.
"""

from __future__ import annotations

import numpy as np

#: A side is halved while all three sides are longer than this.
LEAF = 32


def halvings(rows: int, inner: int, columns: int, leaf: int = LEAF) -> int:
    side, levels = min(rows, inner, columns), 0
    while side > leaf:
        side, levels = -(-side // 2), levels + 1
    return levels


def _padded(matrix: np.ndarray, levels: int) -> np.ndarray:
    step = 1 << levels
    rows, columns = (-(-n // step) * step for n in matrix.shape)
    if matrix.shape == (rows, columns):
        return matrix
    out = np.zeros((rows, columns), dtype=np.int64)
    out[: matrix.shape[0], : matrix.shape[1]] = matrix
    return out


def _peak(matrix: np.ndarray) -> int:
    return max(-int(matrix.min()), int(matrix.max())) if matrix.size else 0


def _multiply(a: np.ndarray, b: np.ndarray, levels: int, small: bool) -> np.ndarray:
    if not levels:
        if small:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
        return a @ b
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    down = levels - 1
    p1 = _multiply(a11 + a22, b11 + b22, down, small)
    p2 = _multiply(a21 + a22, b11, down, small)
    p3 = _multiply(a11, b12 - b22, down, small)
    p4 = _multiply(a22, b21 - b11, down, small)
    p5 = _multiply(a11 + a12, b22, down, small)
    p6 = _multiply(a21 - a11, b11 + b12, down, small)
    p7 = _multiply(a12 - a22, b21 + b22, down, small)
    out = np.empty((2 * i, 2 * j), dtype=np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of two 64-bit integer matrices."""
    levels = halvings(a.shape[0], a.shape[1], b.shape[1], leaf)
    inner = -(-a.shape[1] // (1 << levels))
    # an operand at the bottom is a sum of at most 2**levels entries
    small = inner * (_peak(a) << levels) * (_peak(b) << levels) < 1 << 53
    with np.errstate(over="ignore"):
        whole = _multiply(_padded(a, levels), _padded(b, levels), levels, small)
    return whole[: a.shape[0], : b.shape[1]]
