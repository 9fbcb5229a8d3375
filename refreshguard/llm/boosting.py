"""Small gradient-boosted trees for binary labels, fitted to all rows of a table.

A row is a block of examples: per trait the number of the bin it falls in (one
byte), and the label.  Each level of a tree is one pass that sums gradients by
node, trait and bin; only these sums, of a fixed size, reach the driver.  They are
whole numbers, so the trees do not depend on how the blocks are dealt out.
Blocks of ``BLOCK`` examples in all are summed where they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
BLOCK = 20_000
UNIT = 1 << 30  # gradients are summed as multiples of 1 / UNIT


@dataclass
class Boosted:
    """Trees as flat arrays (feature, cut, left, right, value; feature -1 is a leaf)."""

    prior: float = 0.0
    trees: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        for tree in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                feature = tree[at, 0].astype(np.int64)
                inner = feature >= 0
                if not inner.any():
                    break
                value = x[np.arange(len(x)), np.maximum(feature, 0)]
                below = np.where(value <= tree[at, 1], tree[at, 2], tree[at, 3])
                at = np.where(inner, below.astype(np.int64), at)
            out += tree[at, 4]
        return out


def quantiles(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Cuts between the bins of a trait, from its different values in rising order and their weights."""
    total = np.cumsum(weights)
    at = np.floor(np.linspace(0, 1, BINS + 1)[:-1] * max(total[-1] - 1, 0))
    cuts = np.unique(values[np.minimum(np.searchsorted(total, at, side="right"), len(values) - 1)])
    return cuts[cuts < values[-1]]


def _codes(codes: bytes, width: int) -> np.ndarray:
    return np.frombuffer(codes, np.uint8).reshape(-1, width)


def _sums(block: tuple, model: Boosted, tree: np.ndarray | None, weights: list[float],
          width: int) -> np.ndarray:
    """Gradients and curvatures of a block by open node, trait and bin (3 + 1 axes)."""
    x, y = _codes(block[0], width), np.frombuffer(block[1], np.uint8)
    w = np.asarray(weights)[np.frombuffer(block[2], np.uint8)]
    p = 1 / (1 + np.exp(-model.margin(x)))
    g = np.rint(w * (p - y) * UNIT).astype(np.int64)
    h = np.rint(w * p * (1 - p) * UNIT).astype(np.int64)
    at = np.zeros(len(x), dtype=np.int64) if tree is None else Boosted(0.0, [tree]).margin(x).astype(np.int64)
    n = 1 if tree is None else int(tree[:, 4].max()) + 1
    out = np.zeros((2, max(n, 1), width, BINS + 1), dtype=np.int64)
    keep = at >= 0
    for f in range(width):
        cell = (at[keep], x[keep, f].astype(np.int64))
        np.add.at(out[0, :, f], cell, g[keep])
        np.add.at(out[1, :, f], cell, h[keep])
    return out


def _summed(blocks: DataFrame | list[tuple], *how) -> np.ndarray:
    if isinstance(blocks, list):
        return sum(_sums(b, *how) for b in blocks)

    def partial(batches):
        total = 0
        for batch in batches:
            for block in batch.itertuples(index=False, name=None):
                total = total + _sums(block, *how)
        if isinstance(total, np.ndarray):
            flat = total.reshape(2, -1)
            at = np.flatnonzero(flat.any(axis=0))
            yield pd.DataFrame({"cell": at, "g": flat[0, at], "h": flat[1, at]})

    _, tree, _, width = how
    shape = (2, 1 if tree is None else int(tree[:, 4].max()) + 1, width, BINS + 1)
    rows = blocks.mapInPandas(partial, "cell long, g long, h long").groupBy("cell").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
    out = np.zeros((2, int(np.prod(shape[1:]))), dtype=np.int64)
    out[:, rows["cell"]] = rows["g"], rows["h"]
    return out.reshape(shape)


def _split(g: np.ndarray, h: np.ndarray, counts: list[int]):
    """(gain, trait, bin) of the best split of a node."""
    best = (1e-3, -1, 0)
    for f, n in enumerate(counts):
        if not n:
            continue
        left_g, left_h = np.cumsum(g[f])[:n], np.cumsum(h[f])[:n]
        all_g, all_h = g[f].sum(), h[f].sum()
        gain = (left_g ** 2 / (left_h + 1.0) + (all_g - left_g) ** 2 / (all_h - left_h + 1.0)
                - all_g ** 2 / (all_h + 1.0))
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k)
    return best


def boost(x: np.ndarray, y: np.ndarray, **how) -> Boosted:
    """Trees from examples at hand, one block of weight 1."""
    cuts = [quantiles(*np.unique(column, return_counts=True)) for column in x.T] if len(y) else []
    codes = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]) if cuts else x
    block = (codes.astype(np.uint8).tobytes(), y.astype(np.uint8).tobytes(), bytes(len(y)))
    if not len(y) or y.min() == y.max():
        how["rounds"] = 0
    return valued(boost_blocks([block], y.mean() if len(y) else 0.0, [1.0], [len(c) for c in cuts], **how), cuts)


def boost_blocks(blocks: DataFrame | list[tuple], share: float, weights: list[float], counts: list[int],
          rounds: int = 40, depth: int = 3, rate: float = 0.3) -> Boosted:
    """Newton boosting of the logistic loss; a cut is the number of a bin.

    ``share`` is the mean label, ``weights`` that of an example of each kind, ``counts`` the
    cuts of each trait.  The columns of the blocks are codes, labels and kinds.
    """
    share = float(np.clip(share, 1e-4, 1 - 1e-4))
    model = Boosted(float(np.log(share / (1 - share))))
    for _ in range(rounds):
        nodes = [[-1.0, 0.0, 0.0, 0.0, 0.0]]  # while it grows, a leaf's value is its number among the open ones
        done: dict[int, float] = {}
        opened = [0]
        for level in range(depth):
            tree = np.array(nodes)
            tree[:, 4] = -1
            tree[opened, 4] = range(len(opened))
            sums = _summed(blocks, model, tree if level else None, weights, len(counts)) / UNIT
            after = []
            for me, g, h in zip(opened, *sums):
                _, f, k = _split(g, h, counts)
                done[me] = -rate * g[0].sum() / (h[0].sum() + 1.0)
                if f < 0:
                    continue
                nodes[me][:4] = [float(f), float(k), float(len(nodes)), float(len(nodes) + 1)]
                for part in (slice(None, k + 1), slice(k + 1, None)):
                    done[len(nodes)] = -rate * g[f][part].sum() / (h[f][part].sum() + 1.0)
                    after.append(len(nodes))
                    nodes.append([-1.0, 0.0, 0.0, 0.0, 0.0])
            opened = after
            if not opened:
                break
        model.trees.append(np.array([[*n[:4], done[i]] for i, n in enumerate(nodes)]))
    return model


def valued(model: Boosted, cuts: list[np.ndarray]) -> Boosted:
    """The trees over the traits themselves, their cuts in the place of numbers of bins."""
    trees = [t.copy() for t in model.trees]
    for t in trees:
        for node in t:
            if node[0] >= 0:
                node[1] = cuts[int(node[0])][int(node[1])]
    return Boosted(model.prior, trees)


def calibrate(margin: np.ndarray, y: np.ndarray, w: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (Platt), by Newton steps held near (1, 0)."""
    x = np.column_stack([margin, np.ones(len(margin))])
    beta = np.array([1.0, 0.0])
    ones, zeros = (w * y).sum(), (w * (1 - y)).sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.eye(2)
        beta = beta + np.linalg.solve(hess, x.T @ (w * (target - p)) - (beta - [1.0, 0.0]))
    return float(max(beta[0], 0.0)), float(beta[1])
