"""Nearest neighbours and least spanning trees of points in one task, by arrays over a binary tree of boxes.

Points lie in the order of a space-filling curve; LEAF of them in a row are a leaf, two nodes beside each other a node of the next level. Leaves
meet nodes from the root down, many pairs at a time, and only where boxes leave a doubt: what is held is bounded by PAIRS, not by pairs of points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .subcells import _components

#: Points of a leaf, pairs of points that are compared at once, and leaves that go down the tree together.
LEAF, PAIRS, TOGETHER = 8, 1 << 17, 1 << 11
#: Points whose tree is found from all their distances at once (8 MB).
FEW = 1 << 10


def _spread(x: np.ndarray) -> np.ndarray:
    """31 bits with a zero between each two."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Boxes:
    """A tree over points in the plane. order: points in the order of the curve; levels from the leaves up to the root."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        wide = max(float(x.max() - x.min()), float(y.max() - y.min()), 1.0)
        place = [_spread(np.floor((v - v.min()) * (((1 << 31) - 1) / wide))) for v in (x, y)]
        self.order = np.argsort(place[0] | (place[1] << np.uint64(1)), kind="stable")
        self.n, self.x, self.y = len(x), x[self.order].astype(float), y[self.order].astype(float)
        self.first = np.arange(0, self.n, LEAF)
        self.low, self.high = ([self.up(v, f) for v in (self.x, self.y)] for f in (np.minimum, np.maximum))
        self.top = len(self.low[0]) - 1

    def up(self, values: np.ndarray, f: np.ufunc) -> list[np.ndarray]:
        """f of the values of each node, by level."""
        out = [f.reduceat(values, self.first)]
        while len(out[-1]) > 1:
            out.append(f.reduceat(out[-1], np.arange(0, len(out[-1]), 2)))
        return out

    def gap(self, q: np.ndarray, t: np.ndarray, level: int) -> np.ndarray:
        """Least squared distance of a point in each leaf q and one in the node t."""
        out = np.zeros(len(q))
        for low, high in zip(self.low, self.high, strict=True):
            g = np.maximum(np.maximum(low[0][q] - high[level][t], low[level][t] - high[0][q]), 0)
            out += g * g
        return out

    def down(self, q: np.ndarray, t: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Each pair with both children of its node."""
        q, t = np.repeat(q, 2), np.repeat(t * 2, 2)
        t[1::2] += 1
        inside = t < len(self.low[0][level - 1])
        return q[inside], t[inside]

    def points(self, leaf: np.ndarray) -> np.ndarray:
        """Points of each leaf, and n where it has fewer than LEAF."""
        return np.minimum(leaf[..., None] * LEAF + np.arange(LEAF), self.n)


def _runs(length: np.ndarray, most: float) -> Iterator[slice]:
    """Runs of about `most` in all."""
    total, a = np.cumsum(length), 0
    while a < len(length):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
        yield slice(a, b)
        a = b


def kth_nearest(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Squared distance of each point to its k-th nearest other one; there are more than k points."""
    tree = Boxes(x, y)
    n = tree.n
    # the k others that come next on the curve, on either side, bound it
    steps = np.full((n, 2 * k), np.inf)
    for s in range(1, k + 1):
        d = (tree.x[s:] - tree.x[:-s]) ** 2 + (tree.y[s:] - tree.y[:-s]) ** 2
        steps[s:, s - 1], steps[:-s, k + s - 1] = d, d
    most = np.maximum.reduceat(np.partition(steps, k - 1, axis=1)[:, k - 1], tree.first)
    px, py = np.append(tree.x, np.inf), np.append(tree.y, np.inf)
    out = np.empty(n + 1)
    for begin in range(0, len(tree.first), TOGETHER):
        q = np.arange(begin, min(begin + TOGETHER, len(tree.first)))
        t = np.zeros(len(q), np.int64)
        for level in range(tree.top, -1, -1):
            near = tree.gap(q, t, level) <= most[q]
            q, t = q[near], t[near]
            if level:
                q, t = tree.down(q, t, level)
        leaf, at, many = np.unique(q, return_index=True, return_counts=True)
        by = np.argsort(many, kind="stable")
        for run in _runs(many[by] * LEAF * LEAF, PAIRS):
            own = by[run]
            place = np.arange(many[own].max())
            other = np.where(place < many[own][:, None], t[np.minimum(at[own][:, None] + place, len(t) - 1)], len(tree.first))
            other = tree.points(other).reshape(len(own), -1)
            mine = tree.points(leaf[own])
            real = np.minimum(mine, n - 1)
            d = (tree.x[real][:, :, None] - px[other][:, None, :]) ** 2 + (tree.y[real][:, :, None] - py[other][:, None, :]) ** 2
            out[mine] = np.partition(d, k, axis=2)[:, :, k]
    found = np.empty(n)
    found[tree.order] = out[:n]
    return found


def spanning_tree(x: np.ndarray, y: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, a, b) of a least spanning tree by w = max(core a, core b, squared distance), in the order of (w, a, b). core: squared distances.

    Weights tie often, and ties decide the tree. Up to FEW points it is _tree_of_few's; beyond, edges of equal weight are told by their ends (a < b),
    so there is one such tree in whatever order they are found.
    """
    if len(x) <= FEW:
        return _tree_of_few(x, y, core)
    tree = Boxes(x, y)
    n, number, core = tree.n, tree.order, core[tree.order]
    cores = tree.up(core, np.minimum)
    label = np.arange(n)
    edges: list[tuple] = []
    while True:
        low, high = tree.up(label, np.minimum), tree.up(label, np.maximum)
        if low[-1][0] == high[-1][0]:
            break
        best = np.full(n, np.inf)

        def weight(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return np.maximum(np.maximum(core[i], core[j]), (tree.x[i] - tree.x[j]) ** 2 + (tree.y[i] - tree.y[j]) ** 2)

        for s in range(1, min(LEAF, n - 1) + 1):  # others next on the curve bound the way out of each component
            i = np.flatnonzero(label[s:] != label[:-s])
            w = weight(i, i + s)
            np.minimum.at(best, label[i], w)
            np.minimum.at(best, label[i + s], w)
        kept = []
        for begin in range(0, len(tree.first), TOGETHER):
            q = np.arange(begin, min(begin + TOGETHER, len(tree.first)))
            t = np.zeros(len(q), np.int64)
            for level in range(tree.top, -1, -1):
                open_ = (low[0][q] != high[level][t]) | (high[0][q] != low[level][t])  # else both are of one component
                q, t = q[open_], t[open_]
                # a point of each side is a bound as well
                i, j = q * LEAF, np.minimum(((2 * t + 1) << level) * LEAF // 2, n - 1)
                w, apart = weight(i, j), label[i] != label[j]
                np.minimum.at(best, label[i[apart]], w[apart])
                most = _bound(best, label, tree, q)
                near = np.maximum(np.maximum(tree.gap(q, t, level), cores[0][q]), cores[level][t]) <= most
                q, t = q[near], t[near]
                if level:
                    q, t = tree.down(q, t, level)
            step = max(1, PAIRS // LEAF**2)
            for k in range(0, len(q), step):
                i = np.repeat(tree.points(q[k : k + step]), LEAF, axis=1).ravel()
                j = np.tile(tree.points(t[k : k + step]), LEAF).ravel()
                inside = (i < n) & (j < n)
                i, j = i[inside], j[inside]
                apart = label[i] != label[j]
                i, j = i[apart], j[apart]
                w = weight(i, j)
                can = w <= best[label[i]]
                i, j, w = i[can], j[can], w[can]
                np.minimum.at(best, label[i], w)
                least = w == best[label[i]]
                kept.append((i[least], j[least], w[least]))
        i, j, w = (np.concatenate([e[k] for e in kept]) for k in range(3))
        least = w == best[label[i]]
        i, j, w = i[least], j[least], w[least]
        a, b = np.minimum(number[i], number[j]), np.maximum(number[i], number[j])
        by = np.lexsort((b, a, label[i]))
        by = by[np.diff(label[i][by], prepend=-1) != 0]
        edges.append((w[by], a[by], b[by]))
        joined = _components(n, label[i[by]], label[j[by]])
        label = joined[label]
    w, a, b = (np.concatenate([e[k] for e in edges]) for k in range(3))
    by = np.lexsort((b, a, w))
    new = np.append(True, (np.diff(a[by]) != 0) | (np.diff(b[by]) != 0))  # two components may have chosen the same edge
    by = by[new]
    return w[by], a[by], b[by]


def _bound(best: np.ndarray, label: np.ndarray, tree: Boxes, q: np.ndarray) -> np.ndarray:
    """Greatest bound of the components in each leaf of q."""
    leaf, place = np.unique(q, return_inverse=True)
    return best[label[np.minimum(tree.points(leaf), tree.n - 1)]].max(axis=1)[place]


def _tree_of_few(x: np.ndarray, y: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, a, b), a tree from all distances: from the first point on, the nearest point that is not in it yet (of equal ones the first) joins the
    point that came near first."""
    n = len(x)
    w = np.maximum(np.maximum(core[:, None], core), (x[:, None] - x) ** 2 + (y[:, None] - y) ** 2)
    best, near, done = w[0].copy(), np.zeros(n, np.int64), np.zeros(n)
    done[0] = np.inf
    to = np.empty(max(n - 1, 0), np.int64)
    out, by = np.empty(len(to)), np.empty(len(to), np.int64)
    for e in range(n - 1):
        k = int(np.argmin(best + done))
        to[e], out[e], by[e] = k, best[k], near[k]
        done[k] = np.inf
        near[w[k] < best] = k
        np.minimum(best, w[k], out=best)
    order = np.lexsort((to, by, out))
    return out[order], by[order], to[order]
