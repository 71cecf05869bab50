"""Small histogram gradient boosting for binary labels (numpy), fit on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS, DEPTH, BINS, RATE, SMOOTH = 40, 3, 16, 0.2, 1.0


@dataclass
class BoostedTrees:
    cuts: list[np.ndarray]                 # bin edges of each feature
    trees: list[list[tuple[int, int]]]     # (feature, bin) of the inner nodes, level by level
    leaves: list[np.ndarray]
    start: float
    threshold: float | np.ndarray = 0.5

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        bins, score = self._bins(x), np.full(len(x), self.start)
        for tree, leaf in zip(self.trees, self.leaves):
            score += RATE * leaf[_leaf(bins, tree)]
        return 1 / (1 + np.exp(-score))


def _leaf(bins: np.ndarray, tree: list[tuple[int, int]]) -> np.ndarray:
    node = np.zeros(len(bins), np.int64)
    features, at = np.array([f for f, _ in tree]), np.array([b for _, b in tree])
    rows = np.arange(len(bins))
    for _ in range(DEPTH):
        node = 2 * node + 1 + (bins[rows, features[node]] > at[node])
    return node - (len(tree))


def _grow(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    node, tree = np.zeros(len(bins), np.int64), []
    for level in range(DEPTH):
        first, count = 2 ** level - 1, 2 ** level
        splits = []
        for k in range(count):
            own = node == first + k
            best = (0.0, 0, BINS)  # a split that sends all rows left
            g, h = gradient[own], hessian[own]
            for f in range(bins.shape[1]):
                gs = np.cumsum(np.bincount(bins[own, f], g, BINS + 1))
                hs = np.cumsum(np.bincount(bins[own, f], h, BINS + 1))
                gain = (gs ** 2 / (hs + SMOOTH) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + SMOOTH)
                        - gs[-1] ** 2 / (hs[-1] + SMOOTH))
                at = int(np.argmax(gain))
                if gain[at] > best[0] + 1e-9:
                    best = (float(gain[at]), f, at)
            splits.append(best[1:])
        tree += splits
        f, at = np.array(splits)[node - first].T
        node = 2 * node + 1 + (bins[np.arange(len(bins)), f] > at)
    leaf = node - (2 ** DEPTH - 1)
    g, h = np.bincount(leaf, gradient, 2 ** DEPTH), np.bincount(leaf, hessian, 2 ** DEPTH)
    return tree, g / (h + SMOOTH)


def fit(x: np.ndarray, y: np.ndarray) -> BoostedTrees:
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(x.shape[1])]
    mean = float(np.clip(y.mean(), 0.01, 0.99))
    model = BoostedTrees(cuts, [], [], float(np.log(mean / (1 - mean))))
    bins, score = model._bins(x), np.full(len(x), model.start)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        tree, leaf = _grow(bins, y - p, p * (1 - p))
        model.trees.append(tree)
        model.leaves.append(leaf)
        score += RATE * leaf[_leaf(bins, tree)]
    return model


def calibrate(model: BoostedTrees, x: np.ndarray, y: np.ndarray, precision: float) -> float:
    """Least threshold from which the held-out rows reach ``precision``; above 1 if none does.

    Of the thresholds that find as many positive rows the highest, with log odds midway between
    the last row that passes and the next (even odds at most if all pass).
    """
    p = model.probability(x)
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    reached = right >= precision * np.arange(1, len(p) + 1)
    last = np.append(np.diff(p[order]) != 0, True) if len(p) else np.empty(0, bool)  # ties go together
    good = np.flatnonzero(reached & last)
    if not len(good):
        return 2.0
    end = good[right[good] == right[good[-1]]][0] + 1
    around = p[order][end - 1:end + 1]
    if len(around) == 1:
        return float(min(around[0], 0.5))
    return float(1 / (1 + np.exp(-np.log(around / (1 - around)).mean())))
