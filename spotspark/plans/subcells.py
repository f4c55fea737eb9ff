"""DBSCAN of datasets in the task they were dealt to: the sub-cells of C1, by arrays over many datasets at once.

A task holds its rows in the order of their keys and takes whole datasets, CHUNK rows of them together: the number of the dataset is part of a
sub-cell's code, so no dataset costs a call of its own. Pairs of points are made PAIRS at a time and only where boxes leave a doubt; two
sub-cells with more than OPEN pairs of core points are told by their quadrants, so crowded places do not cost their pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows that are clustered together, and pairs of points that are held at once.
CHUNK, PAIRS = 1 << 16, 1 << 20
#: Pairs of points of two sub-cells, or of two of their quadrants, that are opened.
OPEN = 1 << 10


def _met(first: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place): first, first + 1 .. of each length, about PAIRS at a time."""
    total, a = np.cumsum(length), 0
    while a < len(length):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right")))
        n = length[a:b]
        yield np.repeat(np.arange(a, b), n), np.arange(n.sum()) + np.repeat(first[a:b] - np.cumsum(n) + n, n)
        a = b


class _Cells:
    """Sub-cells of points in the order of their codes: where each starts, and how many points it has."""

    def __init__(self, code: np.ndarray):
        self.code, self.first, self.of, self.n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places among code of those that are sub-cells, the sub-cells)."""
        if not len(self.code):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        hit = np.flatnonzero(self.code[at] == code)
        return hit, at[hit]


def _packed(c: np.ndarray, reach: int) -> np.ndarray:
    """c from 0 on, wider gaps shortened to reach + 1."""
    values, place = np.unique(c, return_inverse=True)
    return np.cumsum(np.minimum(np.diff(values, prepend=values[:1]), reach + 1)).astype(np.int64)[place]


def _d2(at: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sum((x[a] - x[b]) ** 2 for x in at)


def groups(dataset: np.ndarray, number: np.ndarray, at: list[np.ndarray], eps: float, minpts: int) -> np.ndarray:
    """Group of each point as C1 has it (-1: noise): by dataset, numbered by the least number of a core point; border points go to the
    least label. dataset: ascending whole numbers; at: an array for each dimension."""
    d, reach = len(at), math.ceil(math.sqrt(len(at)))
    out = np.full(len(dataset), -1, np.int32)
    if not len(dataset):
        return out
    sub = [_packed(np.floor(x / (eps / math.sqrt(d) * (1 - 1e-9))), reach) for x in at]
    wide = [int(c.max()) + 1 + 2 * reach for c in sub]
    if (int(dataset[-1]) - int(dataset[0]) + 1) * math.prod(wide) >= 1 << 62 and dataset[0] < dataset[-1]:  # codes would not fit
        half = int(np.searchsorted(dataset, dataset[len(dataset) // 2], "left" if dataset[0] < dataset[len(dataset) // 2] else "right"))
        return np.concatenate([groups(dataset[p], number[p], [x[p] for x in at], eps, minpts) for p in (slice(half), slice(half, None))])
    code = dataset - dataset[0]
    for c, w in zip(sub, wide, strict=True):
        code = code * w + c + reach
    by = np.argsort(code, kind="stable")
    code, dataset, number, at = code[by], dataset[by], number[by], [x[by] for x in at]
    steps = list(itertools.product(range(-reach, reach + 1), repeat=d))
    shift = {s: sum(v * math.prod(wide[k + 1 :]) for k, v in enumerate(s)) for s in steps}

    cells = _Cells(code)
    core = cells.n[cells.of] >= minpts
    thin = np.flatnonzero(~core)
    near = np.zeros(len(thin), np.int64)
    for s in steps:
        own, cell = cells.find(code[thin] + shift[s])
        for row, other in _met(cells.first[cell], cells.n[cell]):
            near += np.bincount(own[row[_d2(at, thin[own[row]], other) <= eps * eps]], minlength=len(thin))
    core[thin[near >= minpts]] = True

    inner = np.flatnonzero(core)
    if not len(inner):
        return out
    nodes = _Cells(code[inner])
    place = [x[inner] for x in at]
    low, high = ([f.reduceat(x, nodes.first) for x in place] for f in (np.minimum, np.maximum))
    label = _components(len(nodes.code), *_links(nodes, place, low, high, [shift[s] for s in steps if s > (0,) * d], eps))
    name = np.full(len(nodes.code), np.iinfo(np.int64).max)
    np.minimum.at(name, label[nodes.of], number[inner])
    named = np.full(len(code), np.iinfo(np.int64).max)
    named[inner] = name[label[nodes.of]]
    rest = np.flatnonzero(~core)
    least = named[rest]
    for s in steps:
        own, cell = nodes.find(code[rest] + shift[s])
        for row, other in _met(nodes.first[cell], nodes.n[cell]):
            hit = _d2(at, rest[own[row]], inner[other]) <= eps * eps
            np.minimum.at(least, own[row[hit]], named[inner[other[hit]]])
    named[rest] = least

    # places of names within their dataset
    some = np.flatnonzero(named < np.iinfo(np.int64).max)
    some = some[np.lexsort((named[some], dataset[some]))]
    new = np.diff(dataset[some], prepend=-1) != 0
    place = np.cumsum(new | (np.diff(named[some], prepend=0) != 0))
    out[by[some]] = place - np.maximum.accumulate(np.where(new, place, 0))
    return out


def _links(nodes: _Cells, at: list[np.ndarray], low: list[np.ndarray], high: list[np.ndarray], shifts: list[int], eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sub-cells (a, b) that hold core points within eps: told by their boxes, else by pairs of points."""
    both = [nodes.find(nodes.code + s) for s in shifts]
    a, b = (np.concatenate([x[k] for x in both]) for k in (0, 1))
    least, most = _apart(low, high, a, b)
    open_ = least <= eps * eps
    a, b, linked = a[open_], b[open_], (most <= eps * eps)[open_]
    doubt = np.flatnonzero(~linked)
    linked[doubt] = _touching(nodes.first, nodes.n, at, low, high, a[doubt], b[doubt], eps)
    return a[linked], b[linked]


def _apart(low: list[np.ndarray], high: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most squared distance of a point in each box a and one in the box b beside it."""
    square = lambda gaps: sum(g * g for g in gaps)
    least = square(np.maximum(np.maximum(lo[a] - hi[b], lo[b] - hi[a]), 0) for lo, hi in zip(low, high, strict=True))
    return least, square(np.maximum(hi[a] - lo[b], hi[b] - lo[a]) for lo, hi in zip(low, high, strict=True))


def _touching(first: np.ndarray, n: np.ndarray, at: list[np.ndarray], low: list[np.ndarray], high: list[np.ndarray], a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """For each pair of runs of points (a, b) whose boxes leave a doubt: whether they hold points within eps. Up to OPEN pairs of points are
    opened; runs with more are split at the middle of their boxes, until the boxes tell."""
    linked, d = np.zeros(len(a), bool), len(at)
    few = n[a] * n[b] <= OPEN
    some = np.flatnonzero(few)
    for pair, one in _met(first[a[some]], n[a[some]]):
        to = b[some[pair]]
        can = sum(np.maximum(np.maximum(lo[to] - x[one], x[one] - hi[to]), 0) ** 2 for x, lo, hi in zip(at, low, high, strict=True)) <= eps * eps
        pair, one, to = pair[can], one[can], to[can]
        for row, other in _met(first[to], n[to]):
            linked[some[pair[row[_d2(at, one[row], other) <= eps * eps]]]] = True
    many, quadrants = np.flatnonzero(~few), np.arange(1 << d)
    step = max(1, PAIRS >> 2 * d)
    for pair in (many[k : k + step] for k in range(0, len(many), step)):
        runs = np.unique(np.concatenate([a[pair], b[pair]]))
        own = np.repeat(np.arange(len(runs)), n[runs])
        place = np.arange(len(own)) + np.repeat(first[runs] - np.cumsum(n[runs]) + n[runs], n[runs])
        code = own << d
        for k, (x, lo, hi) in enumerate(zip(at, low, high, strict=True)):
            middle = lo[runs] + (hi[runs] - lo[runs]) / 2
            middle = np.where(middle < hi[runs], middle, lo[runs])  # the highest point is always above it
            code |= (x[place] > middle[own]).astype(np.int64) << k
        by = np.argsort(code, kind="stable")
        parts, inside = _Cells(code[by]), [x[place[by]] for x in at]
        lows, highs = ([f.reduceat(x, parts.first) for x in inside] for f in (np.minimum, np.maximum))
        part = np.full(len(runs) << d, -1)
        part[parts.code] = np.arange(len(parts.code))
        of_a, of_b = (part[(np.searchsorted(runs, side[pair]) << d)[:, None] + quadrants] for side in (a, b))
        whose, left, right = np.repeat(pair, 1 << 2 * d), np.repeat(of_a, 1 << d, axis=1).ravel(), np.tile(of_b, 1 << d).ravel()
        met = (left >= 0) & (right >= 0)
        whose, left, right = whose[met], left[met], right[met]
        least, most = _apart(lows, highs, left, right)
        linked[whose[most <= eps * eps]] = True
        doubt = (least <= eps * eps) & ~linked[whose]
        if doubt.any():
            linked[whose[doubt][_touching(parts.first, parts.n, inside, lows, highs, left[doubt], right[doubt], eps)]] = True
    return linked


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node reachable over the links of a and b, for each of n nodes."""
    label = np.arange(n)
    while True:
        new, least = label.copy(), np.minimum(label[a], label[b])
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def values(column: pa.ChunkedArray) -> np.ndarray:
    kind = pa.int64() if pa.types.is_integer(column.type) else pa.float64()
    return column.cast(kind).fill_null(0).to_numpy()


def clustered(keys: tuple[str, ...], dims: tuple[str, ...], eps: float, minpts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function of the batches of a task, whose rows are in the order of keys: the rows with their group. Rows without a key or a place are noise."""

    def found(rows: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        good = np.ones(len(rows), bool)
        for c in (*keys, *dims):
            good &= pc.is_valid(rows[c]).to_numpy()
        at = [values(rows[c]) for c in dims]
        for x in at:
            good &= np.isfinite(x)
        group = np.full(len(rows), -1, np.int32)
        group[good] = groups(np.cumsum(new)[good], values(rows["loc_id"])[good], [x[good] for x in at], eps, minpts)
        yield from rows.append_column("group", pa.array(group)).to_batches()

    return whole_datasets(keys, found)


def whole_datasets(keys: tuple[str, ...], found: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function of the batches of a task, whose rows are in the order of keys: what found makes of about CHUNK rows of whole datasets, given with
    a mark at the first row of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                n += batch.num_rows
                if n < CHUNK:
                    continue
            if not n:
                continue
            rows = pa.Table.from_batches([b for b in held if b.num_rows])
            new = np.ones(n, bool)
            for k, c in enumerate(rows[c].combine_chunks() for c in keys):
                differ = pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
                new[1:] = differ if k == 0 else new[1:] | differ
            end = n if batch is None else int(np.flatnonzero(new)[-1])  # the last dataset may go on
            if end:
                yield from found(rows.slice(0, end), new[:end])
            held, n = rows.slice(end).to_batches(), n - end

    return run
