"""Gradient-boosted trees for a small dense table, and isotonic calibration (numpy, bounded samples only)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Complete binary tree of a fixed depth: node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray
    bound: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        inner = len(self.feature)
        rows = np.arange(len(x))
        while inner and node.size and node[0] < inner:
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.bound[node])
        return self.value[node - inner]


@dataclass
class Boosted:
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    rate: float = 0.15

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += self.rate * tree.predict(x)
        return out


def _grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int,
          ridge: float, least: int) -> Tree:
    inner = 2 ** depth - 1
    feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(x), np.int64)
    n_bins = max(len(c) for c in cuts) + 1
    for level in range(depth):
        for at in range(2 ** level - 1, 2 ** (level + 1) - 1):
            rows = np.flatnonzero(node == at)
            best = 1e-6
            if len(rows) >= 2 * least:
                total_g, total_h = g[rows].sum(), h[rows].sum()
                for f, cut in enumerate(cuts):
                    if len(cut) == 0:
                        continue
                    b = bins[rows, f]
                    gs = np.cumsum(np.bincount(b, g[rows], n_bins))[:len(cut)]
                    hs = np.cumsum(np.bincount(b, h[rows], n_bins))[:len(cut)]
                    ns = np.cumsum(np.bincount(b, minlength=n_bins))[:len(cut)]
                    gain = gs ** 2 / (hs + ridge) + (total_g - gs) ** 2 / (total_h - hs + ridge) \
                        - total_g ** 2 / (total_h + ridge)
                    gain[(ns < least) | (len(rows) - ns < least)] = 0
                    if gain.max() > best:
                        best, feature[at], bound[at] = float(gain.max()), f, cut[int(gain.argmax())]
            node[rows] = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
    leaf = node - inner
    gs, hs = np.bincount(leaf, g, 2 ** depth), np.bincount(leaf, h, 2 ** depth)
    return Tree(feature, bound, -gs / (hs + ridge))


def fit_boosted(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, ridge: float = 5.0,
                n_bins: int = 64) -> Boosted:
    """Logistic loss, second-order leaf values, splits at quantiles of each feature; a side of a split has at
    least one of a hundred rows (2 to 20)."""
    least = max(2, min(20, len(y) // 100))
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins)[1:-1])) for f in range(x.shape[1])]
    # a mostly constant feature still gets a cut between its usual value and the rest
    cuts = [np.unique(np.concatenate((c, [x[:, f].min()]))) for f, c in enumerate(cuts)]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    raw = np.full(len(x), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(raw, -35, 35)))
        tree = _grow(x, bins, cuts, p - y, np.maximum(p * (1 - p), 1e-6), depth, ridge, least)
        model.trees.append(tree)
        raw += model.rate * tree.predict(x)
    return model


def fit_isotonic(raw: np.ndarray, y: np.ndarray, prior: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: increasing knots (raw value, share of label 1); ties in ``raw`` are pooled first.
    Each step is drawn to the overall share by ``prior`` rows, so a step of few rows says little."""
    values, at = np.unique(raw, return_inverse=True)
    weight = np.bincount(at).astype(float)
    total = np.bincount(at, y)
    blocks: list[list[float]] = []  # [low, high, weight, total]
    for v, w, t in zip(values.tolist(), weight.tolist(), total.tolist(), strict=True):
        blocks.append([v, v, w, t])
        while len(blocks) > 1 and blocks[-2][3] / blocks[-2][2] >= blocks[-1][3] / blocks[-1][2]:
            _, high, w2, t2 = blocks.pop()
            blocks[-1][1] = high
            blocks[-1][2] += w2
            blocks[-1][3] += t2
    base = float(np.mean(y))
    xs = [v for b in blocks for v in ((b[0], b[1]) if b[1] > b[0] else (b[0],))]
    ps = [p for b in blocks for p in (((b[3] + prior * base) / (b[2] + prior),) * (2 if b[1] > b[0] else 1))]
    return np.array(xs), np.maximum.accumulate(np.array(ps))
