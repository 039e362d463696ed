"""Eigenpairs of a symmetric matrix inside an interval, by contour integration.

The projector onto the eigenvectors with eigenvalues inside a circle is the integral of the resolvent
(zI - A)^-1 along it. Gauss-Legendre nodes on the upper half suffice, as A is real. The projector, by its
complex shifted solves, is applied to a block of vectors; Rayleigh-Ritz in the space they span gives
eigenpairs, and the step is repeated on these until their residuals vanish. How many eigenvalues there
must be is known beforehand by Sylvester's law: the negative pivots of A - sI count those below s.
"""

from __future__ import annotations

import numpy as np

#: Nodes on the upper half circle, and refinements at most.
NODES, STEPS = 8, 40


class Inertia:
    """Numbers of eigenvalues below given shifts: reduction to tridiagonal form once, then pivots."""

    def __init__(self, a: np.ndarray) -> None:
        a, n = np.array(a, float), len(a)
        self.off = np.zeros(max(0, n - 1))
        for k in range(n - 1):
            x = a[k + 1:, k]
            size = np.linalg.norm(x)
            if n - k == 2 or not size:
                self.off[k] = x[0] if n - k == 2 else 0.0
                continue
            v = x.copy()
            self.off[k] = -np.copysign(size, x[0])
            v[0] -= self.off[k]
            v /= np.linalg.norm(v)
            rest = a[k + 1:, k + 1:]
            p = rest @ v
            p -= (v @ p) * v
            rest -= 2 * (np.outer(v, p) + np.outer(p, v))
        self.main = np.diag(a).copy()

    def below(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for k, d in enumerate(self.main.tolist()):
            pivot = d - shift - (self.off[k - 1] ** 2 / pivot if k else 0.0)
            if not pivot:
                pivot = np.finfo(float).tiny
            count += int(pivot < 0)
        return count


def _cut(inertia: Inertia, lo: float, hi: float, clear: float) -> float | None:
    """A point between lo and hi with no eigenvalue next to it, or None if there is no room."""
    for share in (0.5, 0.41, 0.59, 0.33, 0.67, 0.26, 0.74, 0.19, 0.81):
        s = lo + share * (hi - lo)
        if hi - lo > 8 * clear and inertia.below(s - clear) == inertia.below(s + clear):
            return s
    return None


def intervals(a: np.ndarray, want: int, most: int = 6, floor: float = 1e-12) -> list[tuple[float, float, int]]:
    """Disjoint (lo, hi, eigenvalues inside) which together hold the ``want`` greatest eigenvalues, greatest
    first. Eigenvalues up to ``floor`` of the norm count as zero and are left out. An interval holds up to
    ``most``, more only where they cannot be told apart."""
    top = float(np.abs(a).sum(axis=1).max(initial=0.0))  # no eigenvalue is greater
    if not top:
        return []
    inertia, n = Inertia(a), len(a)
    clear, lo, hi = 1e-13 * top, floor * top, top * (1 + 1e-9)
    low, high = lo, hi
    while n - inertia.below(low) > want + most:  # raise the lower end
        s = _cut(inertia, low, high, clear)
        if s is None:
            break
        low, high = (s, high) if n - inertia.below(s) >= want else (low, s)
    todo, out = [(low, hi)], []
    while todo:
        lo, hi = todo.pop()
        count = inertia.below(hi) - inertia.below(lo)
        s = _cut(inertia, lo, hi, clear) if count > most else None
        if s is not None:
            todo += [(lo, s), (s, hi)]
        elif count:
            out.append((lo, hi, count))
    return out


def eigenpairs(a: np.ndarray, lo: float, hi: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between lo and hi, and unit eigenvectors as columns, greatest first.

    Fails if as many are not found: none is missed silently.
    """
    n = len(a)
    centre, radius = (lo + hi) / 2, (hi - lo) / 2
    x, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi * (x + 1) / 2)
    nodes, weights = centre + radius * turn, radius * weight * turn / 2
    scale = max(abs(lo), abs(hi))
    eye = np.eye(n)
    size = min(n, count + count // 2 + 4)
    while True:
        block = np.random.default_rng(7).standard_normal((n, size))
        before = np.inf
        for _ in range(STEPS):
            block = sum((w * np.linalg.solve(z * eye - a, block)).real for z, w in zip(nodes, weights))
            basis = np.linalg.qr(block)[0]
            values, turns = np.linalg.eigh(basis.T @ a @ basis)
            block = basis @ turns
            inside = (values > lo) & (values < hi)
            worst = np.linalg.norm(a @ block - block * values, axis=0)[inside].max(initial=0.0)
            if inside.sum() == count and (worst <= 1e-15 * n * scale or worst >= before / 2):
                break
            before = worst if inside.sum() == count else np.inf
        if inside.sum() == count and worst <= 1e-9 * scale:
            by = np.argsort(-values[inside])
            return values[inside][by], block[:, inside][:, by]
        if size == n:
            raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues found between {lo} and {hi}")
        size = min(n, 2 * size)
