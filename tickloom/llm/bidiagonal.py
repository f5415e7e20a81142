"""Singular values and right singular vectors of a small square matrix through its bidiagonal form.

Householder reflections make the matrix bidiagonal, the differential quotient-difference algorithm with
shifts finds its squared singular values to high relative accuracy, and twisted factorisations of the
shifted tridiagonal B'B give each vector from the place where its entry is largest. Vectors of values
that lie close together are made orthogonal by inverse iteration within their cluster.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = 1e-290
CLUSTER = 1e-3  # relative gap below which values count as a cluster


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta of the reflection I - beta v v' that turns x into a multiple of its first unit vector."""
    v = x.astype(float).copy()
    size = np.linalg.norm(v)
    if size == 0:
        return v, 0.0
    v[0] += size if v[0] >= 0 else -size
    return v, 2.0 / float(v @ v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of r = U B V' with B upper bidiagonal, r square."""
    b, n = r.astype(float).copy(), len(r)
    right = np.eye(n)
    for k in range(n):
        v, beta = _reflector(b[k:, k])
        b[k:, k:] -= beta * np.outer(v, v @ b[k:, k:])
        if k < n - 2:
            v, beta = _reflector(b[k, k + 1 :])
            b[k:, k + 1 :] -= beta * np.outer(b[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= beta * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(b).copy(), np.diag(b, 1).copy(), right


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One step of dqds; None if the shift went beyond the least value."""
    d, new_q, new_e = q[0] - shift, [], []
    for up, ahead in zip(e, q[1:], strict=True):
        if d < 0:
            return None
        at = max(d + up, TINY)
        ratio = ahead / at
        new_q.append(at)
        new_e.append(up * ratio)
        d = d * ratio - shift
    return None if d < 0 else ([*new_q, d], new_e)


def _shift(q: list[float], e: list[float]) -> float:
    """A lower bound of the least value: one over the trace of the inverse, in positive terms only."""
    term, total = 1.0, 0.0
    for i, x in enumerate(q):
        if x <= TINY:
            return 0.0
        if i:
            term = 1.0 + e[i - 1] / q[i - 1] * term
        total += term / x
    return (1.0 - 64 * EPS) / total if np.isfinite(total) else 0.0


def squared_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling, by dqds with deflation and splitting."""
    blocks, out = [((diagonal**2).tolist(), (upper**2).tolist(), 0.0)], []
    while blocks:
        q, e, sigma = blocks.pop()
        while len(q) > 1:
            small = [i for i, x in enumerate(e) if x <= (EPS / 8) ** 2 * sigma or x <= (EPS / 8) ** 2 * max(q[i + 1], TINY)]
            if small:
                at = small[-1] + 1
                blocks.append((q[:at], e[: at - 1], sigma))
                q, e = q[at:], e[at:]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            shift = _shift(q, e)
            if shift <= EPS * EPS * sigma:
                shift = 0.0
            while (made := _transform(q, e, shift)) is None:
                shift = shift / 2 if shift > TINY else 0.0
            q, e = made
            sigma += shift
        out.append(q[0] + sigma)
    return np.sort(np.array(out))[::-1]


def _safe(x: float) -> float:
    return x if abs(x) > TINY else TINY


class Twisted:
    """B'B as its squared diagonal and products; vectors by twisted factorisations of B'B - value."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray):
        self.n = len(diagonal)
        self.d, self.ld, self.lld = (diagonal**2).tolist(), (diagonal[:-1] * upper).tolist(), (upper**2).tolist()

    def stationary(self, value: float) -> tuple[list[float], list[float], list[float]]:
        """From the top: pivots, multipliers and what the pivots were before the diagonal was added."""
        s, pivots, steps, before = -value, [], [], []
        for i in range(self.n):
            before.append(s)
            pivots.append(_safe(s + self.d[i]))
            if i < self.n - 1:
                steps.append(self.ld[i] / pivots[i])
                s = self.lld[i] * (s / pivots[i]) - value
        return pivots, steps, before

    def vector(self, value: float) -> tuple[np.ndarray, float]:
        """The unit vector of the twist that fits the value best, and the correction to the value."""
        n = self.n
        _, steps, before = self.stationary(value)
        p, ups, progress = self.d[-1] - value, [0.0] * (n - 1), [0.0] * n
        progress[-1] = p
        for i in range(n - 2, -1, -1):
            pivot = _safe(self.lld[i] + p)
            ups[i] = self.ld[i] / pivot
            p = self.d[i] * (p / pivot) - value
            progress[i] = p
        gamma = np.array(before) + np.array(progress) + value
        k = int(np.argmin(np.abs(gamma)))
        z = np.zeros(n)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -steps[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -ups[i] * z[i]
        size = float(z @ z)
        return z / np.sqrt(size), float(gamma[k]) / size

    def solved(self, value: float, right: np.ndarray) -> np.ndarray:
        """(B'B - value)^-1 right, to scale."""
        pivots, steps, _ = self.stationary(value)
        x = right.tolist()
        for i in range(1, self.n):
            x[i] -= steps[i - 1] * x[i - 1]
        x = [a / b for a, b in zip(x, pivots, strict=True)]
        for i in range(self.n - 2, -1, -1):
            x[i] -= steps[i] * x[i + 1]
        out = np.array(x)
        return out / np.max(np.abs(out)) if np.all(np.isfinite(out)) and np.any(out) else right

    def unlike(self, z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            for o in others:
                z = z - (o @ z) * o
        return z / max(np.linalg.norm(z), TINY)


def right_vectors(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of a square matrix, falling, and the right vectors (columns) of the first count.

    Values that are zero beside the largest come out as zero.
    """
    n = len(r)
    scale = float(np.max(np.abs(r))) if r.size else 0.0
    if not scale:
        return np.zeros(n), np.eye(n)[:, :count]
    diagonal, upper, right = bidiagonalise(r / scale)
    values = squared_values(diagonal, upper)
    kit, found = Twisted(diagonal, upper), []
    cluster: list[np.ndarray] = []
    rng = np.random.default_rng(0)
    for i, value in enumerate(values[:count]):
        z, off = kit.vector(value)
        if abs(off) < CLUSTER * value and abs(off) > EPS * value:
            z, _ = kit.vector(value + off)
        if i and values[i - 1] - value > CLUSTER * values[i - 1]:
            cluster = []
        if cluster or (i + 1 < n and value - values[i + 1] <= CLUSTER * value):
            for turn in range(4):
                z = kit.unlike(z if turn else z + 1e-3 * rng.standard_normal(n) / np.sqrt(n), cluster)
                z = kit.unlike(kit.solved(value * (1 + EPS * (2 * i + 1)), z), cluster)
        cluster.append(z)
        found.append(z)
    values = np.where(values > (n * EPS) ** 2 * values[0], values, 0.0)
    vectors = right @ np.array(found).T
    return values * scale**2, vectors / np.linalg.norm(vectors, axis=0)
