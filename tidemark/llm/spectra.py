"""Eigendecompositions that grow by one vector at a time.

A :class:`Spectrum` holds the number, sums, mean and the scatter matrix (sum of centred outer products)
of the vectors that it has taken, the scatter as eigenvalues and eigenvectors. Taking a vector is a
rank-one update: the new eigenvalues are the roots of a secular equation between the old ones, the new
eigenvectors follow from them.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Steps of the root search: rational ones converge in fewer than ten, halving takes over after them.
RATIONAL, STEPS = 30, 130


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + sum(weights / (poles - x))``, one above each of the rising ``poles``.

    ``weights`` are positive. A root is given as its distance from the nearer pole, so that it keeps all
    its digits close to one: ``(base, distance)`` with ``base`` the index of that pole.
    """
    k = len(poles)
    index = np.arange(k)
    above = np.append(poles[1:], poles[-1] + weights.sum())
    gap = above - poles
    differ = poles[None, :] - poles[:, None]
    # The sign half-way tells which pole is nearer; the last root has none above it.
    middle = 1 + (weights / (differ - gap[:, None] / 2)).sum(axis=1)
    right = (middle < 0) & (index < k - 1)
    base = index + right
    shifted = poles[None, :] - poles[base][:, None]
    low = np.where(right, -gap / 2, np.where(middle < 0, gap / 2, 0.0))
    high = np.where(right, 0.0, np.where(middle < 0, gap, gap / 2))
    left, over = shifted[index, index], above - poles[base]
    lower = np.tri(k, dtype=bool)
    x = (low + high) / 2
    for step in range(STEPS):
        apart = shifted - x[:, None]
        terms = weights / apart
        slopes = terms / apart
        value = 1 + terms.sum(axis=1)
        down = np.where(lower, slopes, 0).sum(axis=1)
        up = slopes.sum(axis=1) - down
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        done = np.abs(value) <= 4 * EPS * (1 + np.abs(terms).sum(axis=1))
        if done.all():
            break
        below, beyond = left - x, over - x
        c = value - below * down - beyond * up
        a = (below + beyond) * value - below * beyond * (down + up)
        b = below * beyond * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(all="ignore"):
            move = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # Nothing stands above the last root.
            move[-1] = below[-1] + below[-1] ** 2 * down[-1] / (value[-1] - below[-1] * down[-1])
        tried = x + move
        inside = np.isfinite(tried) & (tried > low) & (tried < high) & (step < RATIONAL)
        new = np.where(done, x, np.where(inside, tried, (low + high) / 2))
        if np.array_equal(new, x):
            break
        x = new
    return base, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``vectors @ diag(values) @ vectors.T + outer(v, v)``."""
    z = vectors.T @ v
    square = float(z @ z)
    if square == 0.0:
        return values, vectors
    small = 8 * EPS * max(np.abs(values).max(), square)
    vectors = vectors.copy()
    # Deflation: of equal eigenvalues all but one are turned away from v ...
    starts = np.flatnonzero(np.append(True, np.diff(values) > small))
    for start, end in zip(starts, [*starts[1:], len(values)]):
        if end - start > 1 and (length := np.linalg.norm(z[start:end])) > 0:
            mirror = z[start:end].copy()
            mirror[-1] += np.copysign(length, mirror[-1])
            mirror /= np.linalg.norm(mirror)
            part = vectors[:, start:end]
            vectors[:, start:end] = part - 2 * np.outer(part @ mirror, mirror)
            z[end - 1] = -np.copysign(length, z[end - 1])
            z[start : end - 1] = 0
    # ... and eigenvectors that v hardly touches stay as they are.
    live = np.flatnonzero(np.abs(z) * np.sqrt(square) > small)
    if not len(live):
        return values, vectors
    poles, weights = values[live], z[live] ** 2
    base, x = secular_roots(poles, weights)
    origin = poles[base]
    # apart[i, j] = root i - pole j, with all digits.
    apart = (origin[:, None] - poles[None, :]) + x[:, None]
    # The weights for which these roots are exact make the eigenvectors orthogonal.
    across = poles[:, None] - poles[None, :]
    np.fill_diagonal(across, 1.0)
    ratio = apart / across
    exact = np.sqrt(np.abs(np.prod(ratio, axis=0))) * np.sign(z[live])
    turned = exact[:, None] / -apart.T
    turned /= np.linalg.norm(turned, axis=0)
    values = values.copy()
    values[live] = origin + x
    vectors[:, live] = vectors[:, live] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Number, sums, and the eigendecomposed scatter of the vectors taken so far."""

    def __init__(self, dim: int) -> None:
        self.n = 0
        self.sums = np.zeros(dim, object)
        self.values = np.zeros(dim)
        self.vectors = np.eye(dim)

    @classmethod
    def of(cls, n: int, sums, values, vectors) -> Spectrum:
        own = cls(len(sums))
        own.n, own.sums = int(n), np.array([int(s) for s in sums], object)
        own.values = np.asarray(values, np.float64)
        own.vectors = np.asarray(vectors, np.float64).reshape(len(own.sums), -1)
        return own

    @property
    def mean(self) -> np.ndarray:
        return (self.sums / max(self.n, 1)).astype(np.float64)

    def take(self, x: np.ndarray) -> None:
        """One more vector, of whole numbers."""
        if self.n:
            moved = (x - self.mean) * np.sqrt(self.n / (self.n + 1))
            self.values, self.vectors = rank_one(self.values, self.vectors, moved)
        self.n += 1
        self.sums = self.sums + x.astype(object)

    def join(self, other: Spectrum) -> None:
        """All that another one has taken: a rank-one update for each of its eigenvectors, one for the means."""
        if self.n and other.n:
            apart = (other.mean - self.mean) * np.sqrt(self.n * other.n / (self.n + other.n))
            self.values, self.vectors = rank_one(self.values, self.vectors, apart)
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(value) * vector)
        self.n += other.n
        self.sums = self.sums + other.sums
