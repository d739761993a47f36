"""Small numeric models fitted on bounded samples: boosted trees for a yes/no label, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class BoostedTrees:
    """Complete binary trees of one depth: per inner node a feature and a cut, per leaf a step in log-odds."""

    base: float
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray  # trees x inner nodes; a row goes right when its value is greater
    leaves: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for each row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
              bins: int = 64, ridge: float = 1.0, least_weight: float = 1.0) -> BoostedTrees:
    """Gradient boosting of the logistic loss over histogram cuts, with second-order leaf steps."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    codes = np.column_stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    inner, leaf_count = 2 ** depth - 1, 2 ** depth
    features = np.zeros((trees, inner), dtype=np.int64)
    cuts = np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, leaf_count))
    for t in range(trees):
        p = sigmoid(margin)
        grad, curve = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            place = node - first
            best_gain, best = np.zeros(count), [(0, np.inf)] * count
            for j in range(width):
                if not len(edges[j]):
                    continue
                cells = place * bins + codes[:, j]
                g = np.bincount(cells, grad, count * bins).reshape(count, bins).cumsum(1)
                h = np.bincount(cells, curve, count * bins).reshape(count, bins).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g ** 2 / (all_h + ridge)
                gain[(h < least_weight) | (all_h - h < least_weight)] = 0
                gain = gain[:, :len(edges[j])]
                at = gain.argmax(1)
                for k in range(count):
                    if gain[k, at[k]] > best_gain[k] + 1e-9:
                        best_gain[k], best[k] = gain[k, at[k]], (j, edges[j][at[k]])
            for k in range(count):
                features[t, first + k], cuts[t, first + k] = best[k]
            node = 2 * node + 1 + (x[np.arange(n), features[t, node]] > cuts[t, node])
        place = node - inner
        leaves[t] = -rate * np.bincount(place, grad, leaf_count) / (np.bincount(place, curve, leaf_count) + ridge)
        margin += leaves[t, place]
    return BoostedTrees(base, features, cuts, leaves)


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (margins, shares of label 1), both ascending."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, lowest margin, highest margin
    for m, v in zip(margin[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(m), float(m)])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            mean, weight, _, high = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + mean * weight) / (last[1] + weight)
            last[1], last[3] = last[1] + weight, high
    knots = [(x, b[0]) for b in blocks for x in ((b[2], b[3]) if b[3] > b[2] else (b[2],))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])
