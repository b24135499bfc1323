"""Eigendecompositions of a scatter matrix under rank-one updates, in numpy.

``rank_one`` turns the spectrum of A into that of A + rho u u'. In the basis of
A's eigenvectors this is a diagonal plus a rank-one matrix: entries of no weight
and pairs of equal poles are deflated (the latter after a rotation), and the
other eigenvalues are the roots of the secular equation, one between each two
poles. Roots are kept as distances from the nearer pole, and the eigenvectors
come from the weights for which these roots are exact, so they stay orthogonal
however close two poles are.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)


def _roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho sum z2_j / (d_j - x), as (gap, t): row i of ``gap`` holds
    the poles minus the pole nearest to root i, and ``t`` root i minus that pole."""

    k = len(d)
    right = np.append(d[1:], d[-1] + rho * z2.sum())
    width = right - d
    half = width / 2
    w2 = rho * z2
    start = 1 + (w2 / ((d[None, :] - d[:, None]) - half[:, None])).sum(axis=1)
    lower = start >= 0
    lower[-1] = True
    gap = d[None, :] - np.where(lower, d, right)[:, None]
    low = np.where(lower, 0.0, -half)
    high = np.where(lower, half, 0.0)
    if start[-1] < 0:
        low[-1], high[-1] = half[-1], width[-1]
    t = (low + high) / 2
    i = np.arange(k)
    own, after = gap[i, i], right - np.where(lower, d, right)
    left = np.tri(k, dtype=bool)
    for _ in range(64):
        m = gap - t[:, None]
        q = w2 / m
        r = q / m
        f = 1 + q.sum(axis=1)
        below, whole = (r * left).sum(axis=1), r.sum(axis=1)
        done = np.abs(f) <= 8 * EPS * (1 + np.abs(q).sum(axis=1))
        if done.all():
            break
        high, low = np.where(f >= 0, t, high), np.where(f < 0, t, low)
        a0, a1 = own - t, after - t
        c = f - a0 * below - a1 * (whole - below)
        a, b = (a0 + a1) * f - a0 * a1 * whole, a0 * a1 * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        step[-1] = a0[-1] + a0[-1] * a0[-1] * below[-1] / (f[-1] - a0[-1] * below[-1])
        new = t + step
        new = np.where((new >= low) & (new <= high) & (new != 0), new, (low + high) / 2)
        t = np.where(done, t, new)
    return gap, t


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of V diag(values) V' + rho u u', values ascending;
    ``rho`` is not negative."""

    z = vectors.T @ u
    norm = float(z @ z)
    rho *= norm
    if not rho > 0.0:
        return values, vectors
    z /= np.sqrt(norm)
    d, q = values.copy(), vectors.copy()
    tol = 8 * EPS * max(float(np.abs(d).max()), rho)
    live = rho * np.abs(z) > tol
    order = np.flatnonzero(live)
    gaps = np.diff(d[order])
    pairs = np.hypot(z[order[1:]], z[order[:-1]])
    if len(order) > 1 and (gaps * np.abs(z[order[1:]] * z[order[:-1]]) <= tol * pairs * pairs).any():
        last = -1
        for j in order.tolist():
            if last >= 0:
                tau = float(np.hypot(z[j], z[last]))
                c, s = z[j] / tau, -z[last] / tau
                if abs((d[j] - d[last]) * c * s) <= tol:
                    z[j], z[last] = tau, 0.0
                    live[last] = False
                    q[:, last], q[:, j] = c * q[:, last] + s * q[:, j], c * q[:, j] - s * q[:, last]
                    d[last], d[j] = d[last] * c * c + d[j] * s * s, d[last] * s * s + d[j] * c * c
            last = j
        order = np.flatnonzero(live)
        order = order[np.argsort(d[order], kind="stable")]
    poles, weight = d[order], z[order]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        gap, t = _roots(poles, weight * weight, rho)
        far = t[:, None] - gap  # root i minus pole j
        apart = poles[:, None] - poles[None, :]
        k = len(order)
        apart = np.where(np.arange(k)[:, None] < np.arange(k)[None, :], apart, np.vstack([apart[1:], np.ones((1, k))]))
        exact = np.copysign(np.sqrt(np.abs(np.prod(far / apart, axis=0))), weight)
        w = exact[None, :] / far
    w[~np.isfinite(w)] = 0.0
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    new = d.copy()
    origin = poles - gap[np.arange(k), np.arange(k)]
    new[order] = origin + t
    q[:, order] = q[:, order] @ w.T
    by = np.argsort(new, kind="stable")
    return new[by], q[:, by]


class Spectrum:
    """Count, mean and eigendecomposition of the centred scatter of the rows
    seen. Scatter matrices add up, so spectra of disjoint rows can be joined."""

    def __init__(self, dim: int):
        self.n = 0
        self.mean = np.zeros(dim)
        self.values = np.zeros(dim)
        self.vectors = np.eye(dim)

    def _update(self, u: np.ndarray, rho: float = 1.0) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, u, rho)

    def _shift(self, n: int, mean: np.ndarray) -> None:
        away = mean - self.mean
        total = self.n + n
        if self.n:
            self._update(away, self.n / total * n)
        self.mean = self.mean + away * (n / total)
        self.n = total

    def add(self, rows: np.ndarray) -> None:
        """Take up a block of rows: centred, they are turned by an orthogonal
        matrix, which leaves their scatter as it is, into no more rows than
        dimensions; each of those is one update, the block's mean another."""

        if not len(rows):
            return
        mean = rows.mean(axis=0)
        centred = rows - mean
        for u in np.linalg.qr(centred, mode="r") if len(rows) > rows.shape[1] else centred:
            self._update(u)
        self._shift(len(rows), mean)

    def join(self, other: Spectrum) -> None:
        """Take up the rows of ``other``, one update for each of its components."""

        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self._update(vector, float(value))
        self._shift(other.n, other.mean)

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Spectrum:
        flat = np.frombuffer(data)
        dim = int((np.sqrt(4 * len(flat)) - 2) / 2 + 0.5)
        out = cls(dim)
        out.n, out.mean, out.values = int(flat[0]), flat[1: dim + 1].copy(), flat[dim + 1: 2 * dim + 1].copy()
        out.vectors = flat[2 * dim + 1:].reshape(dim, dim).copy()
        return out
