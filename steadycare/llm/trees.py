"""Histogram gradient-boosted trees, fitted on a bounded sample, and their traversal as flat numpy arrays.

Features are cut into at most 64 bins at quantiles. A tree of depth d is a complete binary tree in heap order: node
i has the children 2i + 1 and 2i + 2; a node that does not split sends every row to the left. A forest is four arrays,
so a whole batch walks a tree with d gathers.
"""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; a larger value goes right
    leaf: np.ndarray  # trees x leaves
    bias: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.bias)
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit_forest(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    penalty: float = 1.0, least: int = 5,
) -> Forest:
    """Boosted trees for the logistic loss. No rows or one class: a constant."""
    n, f = x.shape
    inner = (1 << depth) - 1
    share = (y.sum() + 0.5) / (n + 1)
    bias = float(np.log(share / (1 - share)))
    features, thresholds, leaves = [], [], []
    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(f)]
        codes = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1) + np.arange(f) * bins
        raw = np.full(n, bias)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            gradient, curvature = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, threshold = np.zeros(inner, np.int32), np.full(inner, np.inf)
            for level in range(depth):
                base, width = (1 << level) - 1, 1 << level
                cell = (((node - base) * (f * bins))[:, None] + codes).ravel()
                shape = (width, f, bins)
                g, h, c = (
                    np.bincount(cell, w, width * f * bins).reshape(shape).cumsum(2)
                    for w in (np.repeat(gradient, f), np.repeat(curvature, f), None)
                )
                gt, ht, ct = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
                gain = g**2 / (h + penalty) + (gt - g) ** 2 / (ht - h + penalty) - gt**2 / (ht + penalty)
                gain[(c < least) | (ct - c < least)] = 0
                best = gain.reshape(width, -1).argmax(1)
                for w in range(width):
                    j, b = divmod(int(best[w]), bins)
                    if gain[w, j, b] > 1e-6 and b < len(cuts[j]):
                        feature[base + w], threshold[base + w] = j, cuts[j][b]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
            spot = node - inner
            g = np.bincount(spot, gradient, 1 << depth)
            h = np.bincount(spot, curvature, 1 << depth)
            leaf = -rate * g / (h + penalty)
            raw = raw + leaf[spot]
            features.append(feature)
            thresholds.append(threshold)
            leaves.append(leaf)
    return Forest(
        np.array(features, np.int32).reshape(-1, inner),
        np.array(thresholds, float).reshape(-1, inner),
        np.array(leaves, float).reshape(-1, inner + 1),
        bias,
    )


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the monotone fit of labels to scores by pooling adjacent violators; np.interp reads it."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, first score, last score
    for s, v in zip(scores[order].tolist(), labels[order].tolist()):
        blocks.append([v, 1, s, s])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            v2, w2, _, last = blocks.pop()
            v1, w1, first, _ = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, first, last])
    if not blocks:
        return np.zeros(1), np.zeros(1)
    xs, ys = [], []
    for value, _, first, last in blocks:
        xs += [first, last] if last > first else [first]
        ys += [value, value] if last > first else [value]
    return np.array(xs), np.array(ys)
