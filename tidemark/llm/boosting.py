"""Gradient-boosted trees with logistic loss on small integer features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Forest:
    """Trees as flat arrays; ``slope`` and ``shift`` calibrate the summed score."""

    trees: list = field(default_factory=list)
    base: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.score(x) + self.shift)))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Forest:
    """Newton boosting; splits are the best over all cut points of all features."""
    forest = Forest(base=float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    cuts = [np.unique(x[:, f])[:-1] for f in range(x.shape[1])]
    score = np.full(len(y), forest.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p) + 1e-9
        size = 2 ** (depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        members = {0: np.arange(len(y))}
        for node in range(size):
            rows = members.pop(node, None)
            if rows is None:
                continue
            total_g, total_h = g[rows].sum(), h[rows].sum()
            value[node] = rate * total_g / (total_h + ridge)
            if node >= 2**depth - 1 or len(rows) < 8:
                continue
            best = (1e-6, -1, 0.0)
            for f, points in enumerate(cuts):
                if not len(points):
                    continue
                place = np.searchsorted(points, x[rows, f], side="left")  # cut k has the rows with place <= k left
                left_g = np.cumsum(np.bincount(place, g[rows], len(points) + 1))[:-1]
                left_h = np.cumsum(np.bincount(place, h[rows], len(points) + 1))[:-1]
                gain = left_g**2 / (left_h + ridge) + (total_g - left_g) ** 2 / (total_h - left_h + ridge) - total_g**2 / (total_h + ridge)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, points[k])
            if best[1] >= 0:
                feature[node], cut[node] = best[1], best[2]
                right = x[rows, best[1]] > best[2]
                members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
        tree = (feature, cut, value)
        forest.trees.append(tree)
        score += Forest([tree]).score(x)
    return forest


def calibrate(forest: Forest, x: np.ndarray, y: np.ndarray, steps: int = 200) -> None:
    """Platt scaling on rows that the trees were not fitted on."""
    s = forest.score(x)
    a, b = 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a * s + b)))
        d, w = target - p, p * (1 - p) + 1e-6
        hess = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(d * s).sum(), d.sum()])
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    forest.slope, forest.shift = float(a), float(b)
