"""Gradient-boosted trees for a binary label: histogram splits, monotonic constraints, flat numpy arrays for scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class FlatTrees:
    """All trees' nodes in shared arrays; a leaf's feature is -1 and its children are itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of each row of x. A NaN goes right."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                down = x[rows, np.maximum(f, 0)] <= self.threshold[node]
                node = np.where(f < 0, node, np.where(down, self.left[node], self.right[node]))
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def fit(
    x: np.ndarray, y: np.ndarray, constraints: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, least: int = 8, l2: float = 1.0
) -> FlatTrees:
    """constraints: for each feature 1, -1 or 0 - the score never falls, never rises, or is free as it grows.

    A split on a constrained feature must order its children's values, and the values below them stay on their
    side of the midpoint. Fits of equal data are equal. One class only: no trees, and a bias that answers it.
    """
    n, width = x.shape if x.ndim == 2 else (0, len(constraints))
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 1 - 1e-3
    bias = float(np.log(mean / (1 - mean)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < y.sum() < n:
        edges = [_edges(x[:, j], bins) for j in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        margin = np.full(n, bias)

        def grow(rows: np.ndarray, level: int, low: float, high: float, g: np.ndarray, h: np.ndarray) -> int:
            node = len(feature)
            here = float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), low, high))
            for column, v in ((feature, -1), (threshold, 0.0), (left, node), (right, node), (value, here * rate)):
                column.append(v)
            if level == depth or len(rows) < 2 * least:
                margin[rows] += here * rate
                return node
            best = (1e-6, None)
            g_all, h_all = g[rows].sum(), h[rows].sum()
            score = lambda v, gs, hs: -(gs * v + 0.5 * (hs + l2) * v * v)
            for j in range(width):
                size = len(edges[j]) + 1
                if size == 1:
                    continue
                b = binned[rows, j]
                gl = np.cumsum(np.bincount(b, g[rows], size))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], size))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=size))[:-1]
                vl = np.clip(-gl / (hl + l2), low, high)
                vr = np.clip(-(g_all - gl) / (h_all - hl + l2), low, high)
                gain = score(vl, gl, hl) + score(vr, g_all - gl, h_all - hl) - score(here, g_all, h_all)
                fine = (nl >= least) & (len(rows) - nl >= least) & (constraints[j] * (vr - vl) >= 0)
                gain = np.where(fine, gain, -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (j, k, float(vl[k]), float(vr[k])))
            if best[1] is None:
                margin[rows] += here * rate
                return node
            j, k, vl, vr = best[1]
            middle = (vl + vr) / 2
            below, above = (low, high), (low, high)
            if constraints[j] > 0:
                below, above = (low, middle), (middle, high)
            elif constraints[j] < 0:
                below, above = (middle, high), (low, middle)
            down = binned[rows, j] <= k
            feature[node], threshold[node] = j, float(edges[j][k])
            left[node] = grow(rows[down], level + 1, *below, g, h)
            right[node] = grow(rows[~down], level + 1, *above, g, h)
            return node

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(grow(np.arange(n), 0, -np.inf, np.inf, p - y, p * (1 - p)))
    as_int = lambda v: np.array(v, dtype=np.int64)
    return FlatTrees(as_int(feature), np.array(threshold, dtype=float), as_int(left), as_int(right), np.array(value, dtype=float), as_int(roots), depth, bias)
