"""Exact pruning of scored batches: groups of near rows with bounds on their products.

The rows of a batch are put into groups around pivots p of length one. A row c splits
into its part along p and what lies across it, and so does a query q:

    q.c = (q.p)(c.p) + (across q).(across c)

The last product is at most |across q| |across c|, so the range of c.p and the largest
|across c| of a group bound the products of all its rows, for vectors of any length; on
unit vectors this is the triangle inequality of angles. A group whose upper bound stays
under a query's bar is not scored for it. Pivots only decide how much is skipped, never
what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# groups of a batch
MOST_GROUPS = 64
# rows and queries that one group must stand for on average: grouping then costs a small
# share of scoring, also where nothing can be skipped
LEAST_SHARE = 32
# rows looked at, a group, when the first pivots are chosen
LOOKED_AT = 16
# scores are rounded after the ninth decimal, once or twice
_ROUNDED = 2e-9
# what sums of products may be off, relative to the lengths
_FLOAT = 1e-12


class Groups:
    """One batch of vectors in groups; within a group rows keep their order."""

    def __init__(self, rows: np.ndarray, n_queries: int):
        self.n_rows, self.pivots = len(rows), None
        n = min(MOST_GROUPS, len(rows) // LEAST_SHARE, n_queries // LEAST_SHARE)
        if n < 2:
            self.members = [np.arange(len(rows))]
            return
        pivots = _moved(_apart(rows[:: max(1, len(rows) // (LOOKED_AT * n))], n), rows)
        of = np.argmax(rows @ pivots.T, axis=1)
        order = np.argsort(of, kind="stable")
        used, start = np.unique(of[order], return_index=True)
        self.members = np.split(order, start[1:])
        self.pivots = pivots[used]
        along = np.einsum("ij,ij->i", rows, pivots[of])[order]
        square = np.einsum("ij,ij->i", rows, rows)[order]
        self.least, self.most = np.minimum.reduceat(along, start), np.maximum.reduceat(along, start)
        self.across = np.maximum.reduceat(_across(square, along), start)
        self.length = np.sqrt(np.maximum.reduceat(square, start))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest product a rounded score can show, per query and group."""
        if self.pivots is None:
            away = np.full((len(queries), 1), np.inf)
            return -away, away
        along = queries @ self.pivots.T
        square = np.einsum("ij,ij->i", queries, queries)[:, None]
        at_least, at_most = along * self.least, along * self.most
        wide = _across(square, along) * self.across + _ROUNDED + _FLOAT * np.sqrt(square) * self.length
        return np.minimum(at_least, at_most) - wide, np.maximum(at_least, at_most) + wide

    def nearest_first(self, upper: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Groups with their rows, those near many queries first, so that bars rise early."""
        for g in np.argsort(-upper.mean(axis=0), kind="stable"):
            yield g, self.members[g]


class Tally:
    """Pairs of a query and a corpus row that were scored, and all there were."""

    def __init__(self):
        self.scored = self.pairs = 0


def _across(square: np.ndarray, along: np.ndarray) -> np.ndarray:
    # the difference of two near numbers: widened by what it may have lost
    return np.sqrt(np.maximum(square - along * along, 0.0) + _FLOAT * square)


def _apart(rows: np.ndarray, n: int) -> np.ndarray:
    """n directions among the rows, each the farthest from those before it."""
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    rows = rows / np.where(length > 0, length, 1.0)
    chosen = [0]
    near = rows @ rows[0]
    for _ in range(n - 1):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    return rows[chosen]


def _moved(pivots: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Pivots moved once to the mean direction of their rows."""
    of = np.argmax(rows @ pivots.T, axis=1)
    order = np.argsort(of, kind="stable")
    used, start = np.unique(of[order], return_index=True)
    sums = np.add.reduceat(rows[order], start, axis=0)
    length = np.linalg.norm(sums, axis=1)
    some = length > 0
    pivots = pivots.copy()
    pivots[used[some]] = sums[some] / length[some, None]
    return pivots
