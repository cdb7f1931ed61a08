"""Gradient-boosted trees as flat node arrays, with monotonic constraints.

A fit takes a bounded sample: features are cut into quantile bins, and each tree is grown level by level from the
sums of gradients per bin. A feature may be constrained to push the score one way only: splits that would
break the direction are passed over, and the middle of a constrained split bounds the values below it on both
sides, so that every tree, and thus their sum, keeps the direction over its whole range.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees end to end. A leaf has feature -1 and leads to itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``: all rows walk down all trees together, one level at a time."""
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            at = np.where(x[row, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def constant(share: float) -> Forest:
    """A forest without trees that scores every row ``share``."""
    none = np.zeros(0, dtype=np.int64)
    return Forest(float(np.log(share / (1 - share))), none, none, none, none, none, none, 0)


def fit(x: np.ndarray, y: np.ndarray, direction: np.ndarray, n_trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64,
        ridge: float = 1.0, least: float = 3.0) -> Forest:
    """Logistic loss over rows ``x`` with labels ``y`` (0 or 1, both present); ``direction`` is 1, 0 or -1 per feature.

    ``least`` is the smallest sum of second derivatives on either side of a split.
    """
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    width = max(len(e) for e in edges) + 1
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    cells = binned + np.arange(x.shape[1]) * width
    share = y.mean()
    base = float(np.log(share / (1 - share)))
    total = np.full(len(y), base)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        open_nodes = [(np.arange(len(y)), -np.inf, np.inf, len(nodes))]
        roots.append(len(nodes))
        nodes.append([-1, 0.0, 0, 0, 0.0])
        for level in range(depth + 1):
            below = []
            for rows, low, high, at in open_nodes:
                split = _best_split(cells[rows], g[rows], h[rows], edges, width, direction, ridge, least, low, high) if level < depth else None
                if split is None:
                    value = rate * float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
                    nodes[at] = [-1, 0.0, at, at, value]
                    total[rows] += value
                    continue
                f, b, left_value, right_value = split
                to_left = binned[rows, f] <= b
                middle = (left_value + right_value) / 2
                up, down = direction[f] > 0, direction[f] < 0
                kids = len(nodes)
                nodes[at] = [f, float(edges[f][b]), kids, kids + 1, 0.0]
                nodes += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
                below.append((rows[to_left], middle if down else low, middle if up else high, kids))
                below.append((rows[~to_left], middle if up else low, middle if down else high, kids + 1))
            open_nodes = below
    flat = np.array(nodes)
    whole = flat[:, [0, 2, 3]].astype(np.int64)
    return Forest(base, np.array(roots), whole[:, 0], flat[:, 1], whole[:, 1], whole[:, 2], flat[:, 4], depth)


def _best_split(cells, g, h, edges, width, direction, ridge, least, low, high):
    """Feature, bin and the two sides' values of the split with the largest gain, or None."""
    n_features = cells.shape[1]
    size = n_features * width
    gs = np.bincount(cells.ravel(), weights=np.repeat(g, n_features), minlength=size).reshape(n_features, width).cumsum(axis=1)
    hs = np.bincount(cells.ravel(), weights=np.repeat(h, n_features), minlength=size).reshape(n_features, width).cumsum(axis=1)
    g_all, h_all = gs[:, -1:], hs[:, -1:]
    left = np.clip(-gs / (hs + ridge), low, high)
    right = np.clip(-(g_all - gs) / (h_all - hs + ridge), low, high)
    cost = lambda gsum, hsum, v: gsum * v + 0.5 * (hsum + ridge) * v * v
    own = np.clip(-g_all / (h_all + ridge), low, high)
    gain = cost(g_all, h_all, own) - cost(gs, hs, left) - cost(g_all - gs, h_all - hs, right)
    allowed = (hs >= least) & (h_all - hs >= least) & ((right - left) * direction[:, None] >= 0)
    allowed &= np.arange(width) < np.array([len(e) for e in edges])[:, None]
    gain = np.where(allowed, gain, -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    if not gain[f, b] > 1e-9:
        return None
    return int(f), int(b), float(left[f, b]), float(right[f, b])
