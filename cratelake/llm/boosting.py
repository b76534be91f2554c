"""Gradient-boosted trees in numpy: fitted on a bounded sample, flattened to node arrays to score."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 60
DEPTH = 3
BINS = 64
RATE = 0.15
RIDGE = 5.0
LEAST_ROWS = 20


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees in five arrays; a leaf is its own child, so walks need no test."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of every row: all rows walk a tree together, level by level."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                low = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(low, self.left[at], self.right[at])
            total += self.value[at]
        return total


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray) -> Trees:
    """Logistic boosting on histograms. ``monotone`` holds 1, -1 or 0 per feature.

    A split on a constrained feature is taken only if its two values are in order, and each
    side's values stay beyond the middle of the two in all splits below, so that the sum of the
    trees is monotone in that feature. Without rows, or with one class, there are no trees.
    """
    nodes: list[list[float]] = []
    roots: list[int] = []
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return _flattened(nodes, roots, base)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], 1)
    score = np.full(len(y), base)

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, low: float, high: float) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        here = len(nodes)
        own = float(np.clip(g / (h + RIDGE), low, high))
        nodes.append([0, np.inf, here, here, RATE * own])
        best = None
        for j, cut in enumerate(cuts if depth else []):
            if not len(cut):
                continue
            size = len(cut) + 1
            gs, hs, ns = (np.bincount(binned[rows, j], w, size).cumsum()[:-1] for w in (grad[rows], hess[rows], None))
            lv, rv = gs / (hs + RIDGE), (g - gs) / (h - hs + RIDGE)
            lv, rv = np.clip(lv, low, high), np.clip(rv, low, high)
            gain = gs * lv - (hs + RIDGE) * lv**2 / 2 + (g - gs) * rv - (h - hs + RIDGE) * rv**2 / 2
            fine = (ns >= LEAST_ROWS) & (len(rows) - ns >= LEAST_ROWS)
            if monotone[j]:
                fine &= monotone[j] * (rv - lv) >= 0
            gain = np.where(fine, gain, -np.inf)
            k = int(gain.argmax())
            if best is None or gain[k] > best[0]:
                best = (gain[k], j, k, lv[k], rv[k])
        if best is None or best[0] <= g * own - (h + RIDGE) * own**2 / 2 + 1e-9:
            return here
        _, j, k, lv, rv = best
        side = binned[rows, j] <= k
        bounds = [(low, high), (low, high)]
        if monotone[j]:
            middle = (lv + rv) / 2
            bounds = [(low, middle), (middle, high)] if monotone[j] > 0 else [(middle, high), (low, middle)]
        nodes[here][:2] = [j, cuts[j][k]]
        nodes[here][2] = grow(rows[side], grad, hess, depth - 1, *bounds[0])
        nodes[here][3] = grow(rows[~side], grad, hess, depth - 1, *bounds[1])
        return here

    every = np.arange(len(y))
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(every, y - p, p * (1 - p), DEPTH, -np.inf, np.inf))
        score += _flattened(nodes, roots[-1:], 0.0).score(x)
    return _flattened(nodes, roots, base)


def _flattened(nodes: list[list[float]], roots: list[int], base: float) -> Trees:
    table = np.array(nodes or [[0, np.inf, 0, 0, 0.0]], float)
    return Trees(
        table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64),
        table[:, 3].astype(np.int64), table[:, 4], np.array(roots, np.int64), base,
    )
