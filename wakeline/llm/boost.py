"""Boosted trees over bit features, fitted on counts.

Every example is a small integer whose bits are its features, so a corpus is
summed up by one count for each (code, label): at most two to the number of
bits. Trees have two levels; scores are evaluated as SQL text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

ROUNDS = 24
RATE = 0.3
RIDGE = 1.0


@dataclass
class Trees:
    """``start`` + trees (a, b, c, v): bit a picks bit c (if set) or bit b, that
    bit picks one of two of the four values v; and the calibration."""

    start: float = 0.0
    trees: list[tuple[int, int, int, tuple[float, float, float, float]]] = field(default_factory=list)
    slope: float = 0.0
    offset: float = -20.0  # probability 0 until calibrated

    def score(self, code: np.ndarray) -> np.ndarray:
        out = np.full(len(code), self.start)
        for a, b, c, v in self.trees:
            on_a, on_b, on_c = ((code >> x & 1) == 1 for x in (a, b, c))
            out += np.where(on_a, np.where(on_c, v[3], v[2]), np.where(on_b, v[1], v[0]))
        return out

    def sql(self, code: str) -> str:
        """The calibrated probability as SQL text."""

        tree = "IF(({0} & {a}) <> 0, IF(({0} & {c}) <> 0, {v3!r}D, {v2!r}D), IF(({0} & {b}) <> 0, {v1!r}D, {v0!r}D))"
        terms = [tree.format(code, a=1 << a, b=1 << b, c=1 << c, v0=v[0], v1=v[1], v2=v[2], v3=v[3]) for a, b, c, v in self.trees]
        total = " + ".join([f"{self.start!r}D", *terms])
        return f"(1D / (1D + exp(-({self.offset!r}D + {self.slope!r}D * ({total})))))"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _best(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The bit whose split gains most (the lowest one of equal gains)."""

    g1, h1 = g @ x, h @ x
    g0, h0 = g.sum() - g1, h.sum() - h1
    gain = g1**2 / (h1 + RIDGE) + g0**2 / (h0 + RIDGE)
    at = int(np.argmax(np.round(gain, 9)))
    return at, float(gain[at])


def fit(code: np.ndarray, positive: np.ndarray, negative: np.ndarray, bits: int, rounds: int = ROUNDS) -> Trees:
    """Trees for weighted examples: how often each code was one or the other."""

    order = np.argsort(code)
    code, pos, weight = code[order], positive[order].astype(float), (positive + negative)[order].astype(float)
    model = Trees()
    if not len(code) or not pos.sum() or pos.sum() == weight.sum():
        return model
    x = (code[:, None] >> np.arange(bits) & 1).astype(float)
    model.start = float(np.log(pos.sum() / (weight.sum() - pos.sum())))
    for _ in range(rounds):
        p = _sigmoid(model.score(code))
        g, h = weight * p - pos, weight * p * (1 - p)
        a, _gain = _best(x, g, h)
        side = x[:, a] == 1
        b, c = _best(x[~side], g[~side], h[~side])[0], _best(x[side], g[side], h[side])[0]
        leaf = []
        for rows in ((~side & (x[:, b] == 0)), (~side & (x[:, b] == 1)), (side & (x[:, c] == 0)), (side & (x[:, c] == 1))):
            leaf.append(float(-RATE * g[rows].sum() / (h[rows].sum() + RIDGE)))
        model.trees.append((a, b, c, tuple(leaf)))
    return model


def calibrate(model: Trees, code: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> Trees:
    """Fit the probability's slope and offset on held-out counts (Newton steps
    of a logistic regression with a small ridge); without both labels there
    nothing is ever selected."""

    pos, weight = positive.astype(float), (positive + negative).astype(float)
    if not len(code) or not pos.sum() or pos.sum() == weight.sum():
        return model
    s = model.score(code)
    beta = np.array([0.0, 1.0])
    x = np.stack([np.ones(len(s)), s], axis=1)
    for _ in range(50):
        p = _sigmoid(x @ beta)
        grad = x.T @ (weight * p - pos) + 1e-3 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-10:
            break
    model.offset, model.slope = float(beta[0]), float(beta[1])
    return model
