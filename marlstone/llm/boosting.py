"""Gradient boosted trees, small and deterministic: fitted by numpy on the driver over a bounded set of
labelled rows, evaluated as SQL CASE expressions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    base: float
    trees: list  # nested (feature, threshold, left, right) or a leaf value
    slope: float = 1.0  # of the calibration
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((_values(t, x) for t in self.trees), np.zeros(len(x)))

    def sql(self, features: str) -> str:
        """The calibrated probability, of a SQL array of features."""
        total = " + ".join([repr(float(self.base)) + "D", *(_sql(t, features) for t in self.trees)])
        return f"1 / (1 + exp(-({self.slope!r}D * ({total}) + {self.shift!r}D)))"


def _values(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, t, low, high = tree
    return np.where(x[:, f] < t, _values(low, x), _values(high, x))


def _sql(tree, features: str) -> str:
    if not isinstance(tree, tuple):
        return repr(float(tree)) + "D"
    f, t, low, high = tree
    return f"(case when {features}[{f}] < {float(t)!r}D then {_sql(low, features)} else {_sql(high, features)} end)"


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rate: float, depth: int, least: int):
    leaf = float(rate * g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2 * least:
        return leaf
    best, cut = 1e-6, None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, cg, ch = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
        at = np.flatnonzero(v[1:] > v[:-1]) + 1
        at = at[(at >= least) & (at <= len(v) - least)]
        if len(at):
            gl, hl = cg[at - 1], ch[at - 1]
            gain = gl**2 / (hl + 1) + (cg[-1] - gl) ** 2 / (ch[-1] - hl + 1) - cg[-1] ** 2 / (ch[-1] + 1)
            k = int(gain.argmax())
            if gain[k] > best:
                best, cut = float(gain[k]), (f, float((v[at[k]] + v[at[k] - 1]) / 2))
    if cut is None:
        return leaf
    low = x[:, cut[0]] < cut[1]
    return (*cut, _grow(x[low], g[low], h[low], rate, depth - 1, least), _grow(x[~low], g[~low], h[~low], rate, depth - 1, least))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 20, depth: int = 3, rate: float = 0.3, least: int = 5) -> Boosted:
    """Newton boosting of the logistic loss on the even rows; the odd rows calibrate the score."""
    train, check = np.arange(len(y)) % 2 == 0, np.arange(len(y)) % 2 == 1
    p = float(np.clip(y[train].mean(), 0.01, 0.99))
    model = Boosted(float(np.log(p / (1 - p))), [])
    score = np.full(int(train.sum()), model.base)
    for _ in range(trees):
        q = 1 / (1 + np.exp(-score))
        tree = _grow(x[train], y[train] - q, q * (1 - q), rate, depth, least)
        model.trees.append(tree)
        score += _values(tree, x[train])
    s, t = model.raw(x[check]), y[check] * 0.98 + 0.01
    w = np.array([1.0, 0.0])
    a = np.stack([s, np.ones(len(s))], axis=1)
    for _ in range(25):  # logistic regression of the label on the score
        q = 1 / (1 + np.exp(-a @ w))
        w = w + np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a + 0.01 * np.eye(2), a.T @ (t - q) - 0.01 * (w - np.array([1.0, 0.0])))
    model.slope, model.shift = float(w[0]), float(w[1])
    return model
