"""Gradient-boosted regression trees for a binary label, in numpy, flattened into node arrays.

Every tree is complete with a fixed depth: node k has children 2k+1 and 2k+2, so scoring a matrix is `depth` rounds of
array indexing for all rows at once. A feature may be held monotone: a split on it that would put the larger value on the
wrong side is not taken, and the values below are clipped at the middle of the two sides, which keeps whole trees monotone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes; value <= cut goes left
    leaf: np.ndarray  # trees x leaves
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of x."""
        n, total = len(x), np.full(len(x), self.base)
        rows = np.arange(n)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(n, np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def constant(p: float = 1.0) -> Forest:
    """A forest without trees: the same probability for all rows."""
    p = min(max(p, 1e-6), 1 - 1e-6)
    return Forest(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), float(np.log(p / (1 - p))), 1)


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 48, l2: float = 2.0, min_rows: int = 20) -> Forest:
    """monotone: -1, 0 or 1 for each feature, the direction in which label 1 may only get likelier."""
    n, m = x.shape
    if n == 0 or y.min() == y.max():
        return constant(float(y.mean()) if n else 1.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)  # bin b: edges[b-1] < value <= edges[b]
    width = max(len(e) for e in edges) + 1
    rate_1 = min(max(y.mean(), 1e-6), 1 - 1e-6)
    base = float(np.log(rate_1 / (1 - rate_1)))
    inner, leaves = 2**depth - 1, 2**depth
    out_f, out_c, out_l = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    total = np.full(n, base)
    offsets = np.arange(m) * width
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        low, high = {0: -np.inf}, {0: np.inf}
        for level in range(depth):
            first = 2**level - 1
            for k in range(first, 2 * first + 1):
                lo, hi = low.get(k, -np.inf), high.get(k, np.inf)
                low[2 * k + 1] = low[2 * k + 2] = lo
                high[2 * k + 1] = high[2 * k + 2] = hi
                own = np.flatnonzero(node == k)
                if len(own) < 2 * min_rows:
                    continue
                at = (binned[own] + offsets).ravel()
                g = np.bincount(at, np.repeat(grad[own], m), m * width).reshape(m, width).cumsum(1)
                h = np.bincount(at, np.repeat(hess[own], m), m * width).reshape(m, width).cumsum(1)
                c = np.bincount(at, minlength=m * width).reshape(m, width).cumsum(1)
                left, right = g / (h + l2), (g[:, -1:] - g) / (h[:, -1:] - h + l2)
                gain = g * left + (g[:, -1:] - g) * right - g[:, -1:] ** 2 / (h[:, -1:] + l2)
                wrong = (c < min_rows) | (c[:, -1:] - c < min_rows) | (monotone[:, None] * (right - left) < 0)
                gain = np.where(wrong, -np.inf, gain)
                j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                if not gain[j, b] > 1e-6:
                    continue
                out_f[t, k], out_c[t, k] = j, edges[j][b] if b < len(edges[j]) else np.inf
                if monotone[j]:
                    middle = float(np.clip((left[j, b] + right[j, b]) / 2, lo, hi))
                    up, down = (2 * k + 2, 2 * k + 1) if monotone[j] > 0 else (2 * k + 1, 2 * k + 2)
                    low[up], high[down] = middle, middle
            f, c = out_f[t][node], out_c[t][node]
            node = 2 * node + 1 + (x[np.arange(n), f] > c)
        place = node - inner
        value = np.bincount(place, grad, leaves) / (np.bincount(place, hess, leaves) + l2)
        bounds = np.array([[low.get(inner + i, -np.inf), high.get(inner + i, np.inf)] for i in range(leaves)])
        out_l[t] = rate * np.clip(value, bounds[:, 0], bounds[:, 1])
        total += out_l[t][place]
    return Forest(out_f, out_c, out_l, base, depth)
