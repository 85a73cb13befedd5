"""Search trees over a sample of vectors with gaps: cells for all rows, and which cells a ball around a row can touch.

Vectors with the same coordinates present share a tree; its cells are cut at medians of the sample, so that they follow the density and their number
grows with the data. The distance of two vectors is the root mean square over the coordinates that both have, times the root of the
number of all coordinates; a box bounds it from below by the coordinates shared with its tree. Rows whose pattern of gaps the sample does not have
go to one further cell, which every ball touches.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Sampled rows in a cell, at least; and coordinates that the driver samples in all.
LEAST_SAMPLED = 4
SAMPLE_NUMBERS = 600_000


class Tree(NamedTuple):
    has: np.ndarray      # which coordinates the vectors of this tree have
    dim: np.ndarray      # per node: coordinate that is cut, -1 for a cell
    cut: np.ndarray
    child: np.ndarray    # per node: left child; the right one follows it
    cell: np.ndarray     # per node: number of the cell, -1 above
    low: np.ndarray      # bounds of every node
    high: np.ndarray
    rows: int


def _grow(x: np.ndarray, has: np.ndarray, most: int, first_cell: int) -> Tree:
    dims = x.shape[1]
    dim, cut, child, cell, low, high = [-1], [0.0], [-1], [-1], [np.full(dims, -np.inf)], [np.full(dims, np.inf)]
    work, cells = [(0, np.arange(len(x)))], first_cell
    while work:
        node, rows = work.pop()
        spread = np.where(has, np.ptp(x[rows], axis=0), 0) if len(rows) else np.zeros(dims)
        d = int(spread.argmax()) if dims else 0
        at = float(np.median(x[rows, d])) if dims and spread[d] > 0 else 0.0
        left = x[rows, d] <= at if dims else np.ones(len(rows), bool)
        if left.all() and dims and spread[d] > 0:
            # The median is the maximum: halve the range instead.
            at = float(x[rows, d].min() / 2 + x[rows, d].max() / 2)
            left = x[rows, d] <= at
        if len(rows) <= most or not dims or spread[d] <= 0 or left.all():
            cell[node], cells = cells, cells + 1
            continue
        dim[node], cut[node], child[node] = d, at, len(dim)
        for side in (0, 1):
            dim.append(-1)
            cut.append(0.0)
            child.append(-1)
            cell.append(-1)
            low.append(low[node].copy())
            high.append(high[node].copy())
        high[-2][d] = at
        low[-1][d] = at
        work += [(len(dim) - 2, rows[left]), (len(dim) - 1, rows[~left])]
    return Tree(has, np.array(dim), np.array(cut), np.array(child), np.array(cell), np.array(low), np.array(high), len(x))


class Forest:
    """A tree for every pattern of gaps in the sample; cell 0 takes the rows of all others."""

    def __init__(self, sample: np.ndarray, most: int):
        has = ~np.isnan(sample)
        self.dims, self.trees, self.cells = sample.shape[1], [], 1
        patterns, of = np.unique(has, axis=0, return_inverse=True) if len(sample) else (np.zeros((0, self.dims), bool), np.zeros(0, int))
        for i, pattern in enumerate(patterns):
            if pattern.any():
                tree = _grow(np.where(pattern, sample[of.reshape(-1) == i], 0.0), pattern, most, self.cells)
                self.trees.append(tree)
                self.cells = int(tree.cell.max()) + 1

    def place(self, x: np.ndarray, nearest: bool = False) -> np.ndarray:
        """Cell of every row: in the tree of its own pattern or, with `nearest`, in the one that shares most coordinates with it."""
        has, cell = ~np.isnan(x), np.zeros(len(x), np.int32)
        filled = np.where(has, x, 0.0)
        if nearest:
            shared = np.array([(has & t.has).sum(axis=1) * (1 << 40) + t.rows for t in self.trees]).reshape(len(self.trees), len(x))
            mine = shared.argmax(axis=0) if len(self.trees) else np.full(len(x), -1)
        else:
            mine = np.full(len(x), -1)
            for i, t in enumerate(self.trees):
                mine[(has == t.has).all(axis=1)] = i
        for i, t in enumerate(self.trees):
            rows = np.flatnonzero(mine == i)
            node = np.zeros(len(rows), np.int64)
            while (inner := np.flatnonzero(t.dim[node] >= 0)).size:
                at = node[inner]
                node[inner] = t.child[at] + (filled[rows[inner], t.dim[at]] > t.cut[at])
            cell[rows] = t.cell[node]
        return cell

    def touched(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for every cell that can hold a vector within the row's radius."""
        has = ~np.isnan(x)
        filled = np.where(has, x, 0.0)
        rows_out, cells_out = [np.arange(len(x))], [np.zeros(len(x), np.int32)]
        limit = radius * radius * (1 + 1e-9) + 1e-12
        for t in self.trees:
            both = has & t.has
            share = both.sum(axis=1)
            work = [(0, np.flatnonzero(share > 0))]
            while work:
                node, rows = work.pop()
                gap = np.maximum(np.maximum(t.low[node] - filled[rows], filled[rows] - t.high[node]), 0.0)
                rows = rows[(gap * gap * both[rows]).sum(axis=1) * self.dims / share[rows] <= limit[rows]]
                if not len(rows):
                    continue
                if t.dim[node] < 0:
                    rows_out.append(rows)
                    cells_out.append(np.full(len(rows), t.cell[node], np.int32))
                else:
                    work += [(t.child[node], rows), (t.child[node] + 1, rows)]
        return np.concatenate(rows_out), np.concatenate(cells_out)
