"""Isolation Forest on a small numpy matrix (Liu, Ting & Zhou 2008).

Used only inside Spark grouped-map tasks whose groups are bounded (one refit
window, one tree's subsample); Spark does the partitioning and shuffling.
Random split on a random non-constant feature, subsample ``min(256, n)``
without replacement, depth limit ``ceil(log2(subsample))``; score
``2^(-E[h(x)] / c(subsample))`` with h = leaf depth + c(leaf size).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

EULER = 0.5772156649015329


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search over ``n`` points."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


@dataclass
class Tree:
    feature: np.ndarray  # int, -1 for leaves
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    depth: np.ndarray


def build_tree(X: np.ndarray, rng: np.random.Generator, max_depth: int) -> Tree:
    feature, threshold, left, right, size, depth = [], [], [], [], [], []

    def new_node(n: int, d: int) -> int:
        feature.append(-1); threshold.append(0.0); left.append(-1); right.append(-1)
        size.append(n); depth.append(d)
        return len(feature) - 1

    stack = [(np.arange(X.shape[0]), new_node(X.shape[0], 0))]
    while stack:
        idx, node = stack.pop()
        d = depth[node]
        if d >= max_depth or idx.size <= 1:
            continue
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        candidates = np.flatnonzero(hi > lo)
        if candidates.size == 0:
            continue
        f = int(candidates[rng.integers(candidates.size)])
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        li, ri = idx[go_left], idx[~go_left]
        feature[node] = f
        threshold[node] = thr
        ln, rn_ = new_node(li.size, d + 1), new_node(ri.size, d + 1)
        left[node], right[node] = ln, rn_
        stack.append((li, ln))
        stack.append((ri, rn_))
    return Tree(np.array(feature, dtype=np.int64), np.array(threshold), np.array(left, dtype=np.int64),
                np.array(right, dtype=np.int64), np.array(size, dtype=np.int64), np.array(depth, dtype=np.int64))


@dataclass
class Forest:
    """All trees of one forest in flat arrays (node ids are global; roots are 0 .. n_trees-1)."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    depth: np.ndarray
    tree: np.ndarray
    n_trees: int
    subsample: int


def fit_forest(X: np.ndarray, n_trees: int, subsample: int, seed: int) -> Forest:
    """Grow all trees together, one depth level per step (numpy over every node of the level).

    The drawn rows are kept in the order of their nodes, so that a level's nodes are segments of them."""
    rng = np.random.default_rng(seed)
    n, d = X.shape
    m = min(subsample, n)
    max_depth = int(math.ceil(math.log2(max(m, 2))))
    if m < n:
        idx = np.argpartition(rng.random((n_trees, n)), m - 1, axis=1)[:, :m]
    else:
        idx = np.tile(np.arange(n), (n_trees, 1))
    columns = np.ascontiguousarray(X.T)
    samp = idx.reshape(-1)
    feat = [np.full(n_trees, -1)]
    thr_l = [np.zeros(n_trees)]
    left_l = [np.full(n_trees, -1)]
    size_l = [np.full(n_trees, m)]
    tree_l = [np.arange(n_trees)]
    total = n_trees
    for _ in range(max_depth):
        at = np.flatnonzero(size_l[-1])  # the level's nodes that have rows; samp has the rows of those with several
        pick = rng.random((at.size, d))
        draw = rng.random(at.size)
        many = size_l[-1][at] > 1
        at, pick, draw = at[many], pick[many], draw[many]
        if at.size == 0:
            break
        counts = size_l[-1][at]
        vals = columns.take(samp, axis=1)
        starts = np.cumsum(counts) - counts
        lo = np.minimum.reduceat(vals, starts, axis=1)
        hi = np.maximum.reduceat(vals, starts, axis=1)
        varying = hi > lo
        splittable = varying.any(axis=0)
        k = int(splittable.sum())
        if k == 0:
            break
        pick[~varying.T] = -1.0
        f = np.argmax(pick, axis=1)
        rows = np.arange(at.size)
        t = lo[f, rows] + draw * (hi[f, rows] - lo[f, rows])
        par = at[splittable]
        feat[-1][par] = f[splittable]
        thr_l[-1][par] = t[splittable]
        left_l[-1][par] = total + 2 * np.arange(k)
        moves = np.flatnonzero(np.repeat(splittable, counts))
        of = np.repeat(np.arange(k), counts[splittable])
        value = vals.ravel().take((f[splittable] * samp.size).take(of) + moves)
        child = 2 * of + ~(value < t[splittable].take(of))
        kids = np.bincount(child, minlength=2 * k)
        stay = np.flatnonzero(kids.take(child) > 1)
        child, samp = child.take(stay), samp.take(moves.take(stay))
        # small integers are sorted by radix
        samp = samp.take(np.argsort(child.astype(np.uint16) if 2 * k <= 1 << 16 else child, kind="stable"))
        feat.append(np.full(2 * k, -1))
        thr_l.append(np.zeros(2 * k))
        left_l.append(np.full(2 * k, -1))
        size_l.append(kids)
        tree_l.append(np.repeat(tree_l[-1][par], 2))
        total += 2 * k
    cat = np.concatenate
    left = cat(left_l).astype(np.int64)
    return Forest(cat(feat).astype(np.int64), cat(thr_l), left, np.where(left >= 0, left + 1, -1), cat(size_l).astype(np.int64),
                  np.repeat(np.arange(len(size_l)), [len(x) for x in size_l]), cat(tree_l), n_trees, m)


def _leaves(X: np.ndarray, roots: np.ndarray, nodes: Forest | Tree) -> np.ndarray:
    """The leaf (node id) of every row in the tree of every root: an array (roots, rows)."""
    k, d = X.shape
    values, row = np.ascontiguousarray(X).ravel(), np.tile(np.arange(k) * d, len(roots))
    inner, own = nodes.feature >= 0, np.arange(len(nodes.feature))
    feature = np.where(inner, nodes.feature, 0)
    # leaves lead to themselves; the right child of node i at 2 i, the left one behind it
    child = np.stack([np.where(inner, nodes.right, own), np.where(inner, nodes.left, own)], axis=1).ravel()
    node = np.repeat(roots, k)
    for _ in range(int(nodes.depth.max())):
        go_left = values.take(feature.take(node) + row) < nodes.threshold.take(node)
        node = child.take(2 * node + go_left)
    return node.reshape(len(roots), k)


def forest_score(X: np.ndarray, forest: Forest) -> np.ndarray:
    """Positive score in (0, 1] for every row of ``X``: higher = more isolated."""
    if X.shape[0] == 0:
        return np.zeros(0)
    return _score(X, np.arange(forest.n_trees), forest, forest.subsample)


#: Rows walked through all trees at once: (trees, rows) numbers are in memory, however many rows a task has.
SCORE_ROWS = 1024


def _score(X: np.ndarray, roots: np.ndarray, nodes: Forest | Tree, subsample: int) -> np.ndarray:
    length = nodes.depth + c_factor(nodes.size)
    pieces = np.array_split(X, -(-X.shape[0] // SCORE_ROWS))
    h = np.concatenate([length[_leaves(x, roots, nodes)].mean(axis=0) for x in pieces])
    return np.power(2.0, -h / c_factor([subsample])[0])


def path_lengths(X: np.ndarray, tree: Tree) -> np.ndarray:
    node = np.zeros(X.shape[0], dtype=np.int64)
    rows = np.arange(X.shape[0])
    for _ in range(int(tree.depth.max()) + 1):
        f = tree.feature[node]
        inner = f >= 0
        if not inner.any():
            break
        go_left = X[rows, np.where(inner, f, 0)] < tree.threshold[node]
        node = np.where(inner, np.where(go_left, tree.left[node], tree.right[node]), node)
    return tree.depth[node] + c_factor(tree.size[node])


def anomaly_score(X: np.ndarray, trees: list[Tree], subsample: int) -> np.ndarray:
    """Positive score in (0, 1] against a list of single trees (node-table form)."""
    if X.shape[0] == 0:
        return np.zeros(0)
    sizes = [t.feature.size for t in trees]
    roots = np.cumsum(sizes) - sizes
    first = np.repeat(roots, sizes)  # of each node's tree: ids of all trees' nodes in one row
    column = lambda k: np.concatenate([getattr(t, k) for t in trees])
    nodes = Tree(column("feature"), column("threshold"), column("left") + first, column("right") + first, column("size"), column("depth"))
    return _score(X, roots, nodes, subsample)


def flag_threshold(train_scores: np.ndarray, contamination: float) -> float:
    """Rows scoring strictly above the (1 - contamination) quantile (linear) are anomalies."""
    return float(np.percentile(train_scores, 100.0 * (1.0 - contamination)))


def tree_nodes(tree: Tree) -> dict[str, np.ndarray]:
    return {"node": np.arange(tree.feature.size), "feature": tree.feature, "threshold": tree.threshold,
            "left": tree.left, "right": tree.right, "size": tree.size, "depth": tree.depth}


def tree_from_nodes(nodes) -> Tree:
    o = np.argsort(np.asarray(nodes["node"]))
    g = lambda k, dt: np.asarray(nodes[k])[o].astype(dt)
    return Tree(g("feature", np.int64), g("threshold", np.float64), g("left", np.int64), g("right", np.int64),
                g("size", np.int64), g("depth", np.int64))
