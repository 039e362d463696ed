"""A ball tree over sparse vectors of whole numbers, searched by inner product.

A node is a run of vectors with its centroid c, a radius r around it, and a radius along the axis of each of
its terms. For a query q no vector x of a node has an inner product above <q, c> + |q| r (by Cauchy and
Schwarz on q and x - c), nor above <q, c> plus the radii along the axes that q has: sparse vectors differ
mostly along others, so this is often far less. Radii and bounds are raised by more than all rounding can take
from them, so what a bound excludes is excluded; what is left is scored in whole numbers.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np

#: Vectors of a leaf at most.
LEAF = 32
#: Far above the relative rounding error of a sum of a million doubles.
SLACK = 1e-9


class BallTree:
    """Vectors by row: ``terms`` and ``values`` (whole, not negative) from ``ptr[i]`` to ``ptr[i + 1]``."""

    def __init__(self, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray, size: int) -> None:
        #: Place among the rows given, of the rows in the order of the tree.
        self.rows = np.arange(len(ptr) - 1)
        self._ptr, self._terms, self._values = ptr, terms, values.astype(np.float64)
        self._dense = np.zeros(size)
        self._norms = np.add.reduceat(self._values ** 2, ptr[:-1]) if len(self.rows) else np.zeros(0)
        # Of each node: its rows, children (-1 for none), radius, and by term a sparse centroid and radii.
        self.lo, self.hi, self.left, self.right, self.radius = [], [], [], [], []
        self.centre_terms: list[np.ndarray] = []
        self.centre_values: list[np.ndarray] = []
        self.reach: list[np.ndarray] = []
        if len(self.rows):
            self._split(0, len(self.rows))
        order = self.rows
        lens = np.diff(ptr)[order]
        self.ptr = np.concatenate([[0], np.cumsum(lens)])
        take = np.repeat(ptr[order] - self.ptr[:-1], lens) + np.arange(self.ptr[-1])
        self.terms, self.values = terms[take], values[take]
        del self._ptr, self._terms, self._values, self._dense, self._norms

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some rows, and where each row begins among them."""
        lens = self._ptr[rows + 1] - self._ptr[rows]
        tops = np.cumsum(lens)
        return np.repeat(self._ptr[rows] - (tops - lens), lens) + np.arange(tops[-1]), tops - lens

    def _times(self, at: np.ndarray, begin: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Inner products of some rows with one sparse vector."""
        self._dense[terms] = values
        out = np.add.reduceat(self._dense[self._terms[at]] * self._values[at], begin)
        self._dense[terms] = 0
        return out

    def _row(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self._ptr[row], self._ptr[row + 1])
        return self._terms[span], self._values[span]

    def _split(self, lo: int, hi: int) -> int:
        """A node for the rows from lo to hi; these are put in order on the way."""
        # Nodes still to make: rows, the parent and its side. No recursion, so depth has no limit.
        todo = [(lo, hi, -1, self.left)]
        while todo:
            lo, hi, parent, side = todo.pop()
            node = len(self.lo)
            if parent >= 0:
                side[parent] = node
            rows = self.rows[lo:hi]
            at, begin = self._entries(rows)
            terms, which = np.unique(self._terms[at], return_inverse=True)
            centre = np.bincount(which, self._values[at]) / len(rows)
            most = np.zeros(len(terms))
            np.maximum.at(most, which, self._values[at])
            square, norms = float(centre @ centre), self._norms[rows]
            far = norms - 2 * self._times(at, begin, terms, centre) + square
            self.lo.append(lo)
            self.hi.append(hi)
            self.left.append(-1)
            self.right.append(-1)
            self.centre_terms.append(terms)
            self.centre_values.append(centre)
            self.reach.append((most - centre) + SLACK * most)
            # Cancellation loses at most a tiny share of the norms.
            self.radius.append(float(np.sqrt(max(0.0, far.max()) + SLACK * (norms.max() + square)) * (1 + SLACK)))
            if hi - lo <= LEAF:
                continue
            # Two rows far apart; the others are cut in the middle of their order between these.
            a = rows[int(np.argmax(far))]
            from_a = norms - 2 * self._times(at, begin, *self._row(a)) + self._norms[a]
            b = rows[int(np.argmax(from_a))]
            from_b = norms - 2 * self._times(at, begin, *self._row(b)) + self._norms[b]
            self.rows[lo:hi] = rows[np.argsort(from_a - from_b, kind="stable")]
            middle = (lo + hi) // 2
            todo += [(lo, middle, node, self.left), (middle, hi, node, self.right)]
        return 0

    def top(self, query: np.ndarray, k: int, floor: int, order: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows with the ``k`` greatest inner products with the 0/1 vector of the terms in ``query``, and these;
        only products from ``floor`` on, which is 1 or more. Equal ones go by ``order`` of the rows. The last
        number returned is that of the rows scored. ``wanted`` is a scratch array of zeros, one for each term.
        """
        wanted[query] = 1
        length = float(np.sqrt(len(query)))
        rows, scores, scored = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        heap: list[tuple[float, int]] = []

        def push(node: int) -> None:
            met = np.nonzero(wanted[self.centre_terms[node]])[0]
            inner, along = float(self.centre_values[node][met].sum()), float(self.reach[node][met].sum())
            bound = (inner + min(length * self.radius[node], along)) * (1 + SLACK) + 1
            if bound >= floor:
                heappush(heap, (-bound, node))

        if self.lo and len(query):
            push(0)
        while heap and -heap[0][0] >= floor:
            node = heappop(heap)[1]
            if self.left[node] >= 0:
                push(self.left[node])
                push(self.right[node])
                continue
            lo, hi = self.lo[node], self.hi[node]
            span = slice(self.ptr[lo], self.ptr[hi])
            got = np.add.reduceat(self.values[span] * wanted[self.terms[span]], self.ptr[lo:hi] - self.ptr[lo])
            scored += hi - lo
            enough = got >= floor
            if not enough.any():
                continue
            rows, scores = np.concatenate([rows, self.rows[lo:hi][enough]]), np.concatenate([scores, got[enough]])
            if len(rows) >= k:
                best = np.lexsort((order[rows], -scores))[:k]
                rows, scores = rows[best], scores[best]
                floor = max(floor, int(scores[-1]))  # an equal score may still come first by order
        wanted[query] = 0
        best = np.lexsort((order[rows], -scores))[:k]
        return rows[best], scores[best], scored
