"""K-squared trees over a sparse matrix of few rows and many columns.

The columns are cut into strips as wide as the matrix is high (a power of two), so each strip
is a square whose tree halves rows and columns at once. ``bits[d]`` has four bits for each
non-empty node of level ``d - 1`` (``bits[0]``: one for each strip); an empty quadrant is one
zero bit and nothing below. ``joint`` walks the trees of two matrices with the same columns
together and meets every cell of every pair of rows: pairs of quadrants that are both empty
are only counted, with their width; the rest end in pairs of cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Pairs of cells looked at together.
CELLS = 1 << 18


class Tree(NamedTuple):
    height: int  # the side of a strip is 2 ** height
    n_columns: int
    bits: list[np.ndarray]
    value: np.ndarray  # of the set bits of the last level, in their order


def side_height(n_rows: int) -> int:
    return max(1, int(n_rows - 1).bit_length())


def grow(row: np.ndarray, column: np.ndarray, value: np.ndarray, n_columns: int,
         height: int) -> Tree:
    """The tree of distinct cells."""
    n_strips = (n_columns + (1 << height) - 1) >> height
    inside = column & ((1 << height) - 1)
    code = column >> height
    for d in range(height - 1, -1, -1):
        code = (code << 2) | (((row >> d) & 1) << 1) | ((inside >> d) & 1)
    order = np.argsort(code, kind="stable")
    code = code[order]
    bits = []
    above = np.unique(code >> (2 * height))
    first = np.zeros(n_strips, bool)
    first[above] = True
    bits.append(first)
    for d in range(1, height + 1):
        nodes = np.unique(code >> (2 * (height - d)))
        level = np.zeros(4 * len(above), bool)
        level[4 * np.searchsorted(above, nodes >> 2) + (nodes & 3)] = True
        bits.append(level)
        above = nodes
    return Tree(height, n_columns, bits, value[order])


class Frontier(NamedTuple):
    """Pairs of nodes of one level: the node of each tree (-1: empty), the row block of each,
    and the column block both have."""

    a: np.ndarray
    b: np.ndarray
    row_a: np.ndarray
    row_b: np.ndarray
    column: np.ndarray


def _ranked(bits: np.ndarray) -> np.ndarray:
    """For each bit the number of its node, -1 if it isn't set; a last -1 for no node at all."""
    return np.append(np.where(bits, np.cumsum(bits) - 1, -1), -1)


def joint(a: Tree, b: Tree, rows_a: int, rows_b: int, empty: np.ndarray) -> Iterator[Frontier]:
    """Pairs of cells of which at least one is set, a part at a time.

    ``empty[i, j]`` grows by the number of columns in which row ``i`` of one and row ``j`` of the
    other are both empty.
    """
    height, side = a.height, 1 << a.height
    ranks_a, ranks_b = [_ranked(x) for x in a.bits], [_ranked(x) for x in b.bits]
    n_strips = len(a.bits[0])
    step = max(1, CELLS // (side * max(1, rows_a) * max(1, rows_b)))
    counts = [np.zeros((1 << d, 1 << d), np.int64) for d in range(height + 1)]
    for start in range(0, n_strips, step):
        strip = np.arange(start, min(n_strips, start + step))
        zero = np.zeros(len(strip), np.int64)
        now = Frontier(ranks_a[0][strip], ranks_b[0][strip], zero, zero, strip)
        now = _priced(now, counts[0], side, a.n_columns)
        for d in range(1, height + 1):
            now = _priced(_children(now, ranks_a[d], ranks_b[d]), counts[d], side >> d,
                          a.n_columns, rows_a, rows_b, height - d)
        yield now
    for d, n in enumerate(counts):
        wide = np.repeat(np.repeat(n, side >> d, 0), side >> d, 1)
        empty += wide[:rows_a, :rows_b]


def _children(now: Frontier, rank_a: np.ndarray, rank_b: np.ndarray) -> Frontier:
    parts = []
    for k in range(8):  # row half of the one, row half of the other, column half
        i, j, c = k >> 2, (k >> 1) & 1, k & 1
        parts.append((rank_a[np.where(now.a >= 0, 4 * now.a + 2 * i + c, -1)],
                      rank_b[np.where(now.b >= 0, 4 * now.b + 2 * j + c, -1)],
                      2 * now.row_a + i, 2 * now.row_b + j, 2 * now.column + c))
    return Frontier(*(np.concatenate(x) for x in zip(*parts)))


def _priced(now: Frontier, count: np.ndarray, width: int, n_columns: int, rows_a: int = 1,
            rows_b: int = 1, down: int = 0) -> Frontier:
    """Count pairs of empty quadrants with their width and drop them, and what lies outside."""
    real = (now.row_a << down < rows_a) & (now.row_b << down < rows_b) & (now.column * width < n_columns)
    both = real & (now.a < 0) & (now.b < 0)
    wide = np.minimum(width, n_columns - now.column[both] * width)
    np.add.at(count, (now.row_a[both], now.row_b[both]), wide)
    left = np.flatnonzero(real & ~both)
    return Frontier(*(x[left] for x in now))
