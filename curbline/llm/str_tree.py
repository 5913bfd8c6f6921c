"""Sort-tile-recursive R-trees over integer vectors, and best-first inner-product search in them.

A tree's boxes hold the least and greatest value of every coordinate. A query's inner product
with any vector in a box lies in the interval that adds, coordinate by coordinate, the lesser and
the greater of the products with the box's two bounds. All values are whole numbers that a
double holds exactly, so intervals and scores carry no rounding.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LEAF_ROWS = 128
FANOUT = 8
#: Queries that go through a tree together.
TOGETHER = 512
#: Stands for a missing id and lies behind every id.
NO_ID = np.iinfo(np.int64).max


class Tiles(NamedTuple):
    """A cut of space along one coordinate; ``inner`` are the slabs' own cuts, None at a tile."""

    coordinate: int
    cuts: np.ndarray
    inner: list

    def number(self) -> int:
        return sum(t.number() if t else 1 for t in self.inner)


def _slabs(tiles: int, dims: int) -> list[int]:
    """How many tiles each slab along the next coordinate gets."""
    count = max(2, round(tiles ** (1 / max(1, dims)) + 0.4999))
    return [tiles * (k + 1) // count - tiles * k // count for k in range(min(count, tiles))]


def tiles_of(x: np.ndarray, tiles: int, dims: int | None = None) -> Tiles | None:
    """Sort, tile, recurse: cuts that deal the rows of ``x`` to about equal tiles."""
    if tiles <= 1 or not len(x):
        return None
    dims = x.shape[1] if dims is None else dims
    coordinate = int(np.argmax(x.max(0) - x.min(0)))
    values = np.sort(x[:, coordinate])
    slabs = _slabs(tiles, dims)
    share = np.cumsum(slabs)[:-1] / tiles
    cuts = values[np.minimum((share * len(values)).astype(int), len(values) - 1)]
    slab = np.searchsorted(cuts, x[:, coordinate], side="right")
    inner = [tiles_of(x[slab == k], n, dims - 1) for k, n in enumerate(slabs)]
    return Tiles(coordinate, cuts, inner)


def tile_numbers(x: np.ndarray, tiles: Tiles | None) -> np.ndarray:
    """The tile of every row, counted in the order of the cuts."""
    number = np.zeros(len(x), np.int64)
    if tiles is None:
        return number
    slab, base = np.searchsorted(tiles.cuts, x[:, tiles.coordinate], side="right"), 0
    for k, inner in enumerate(tiles.inner):
        rows = np.flatnonzero(slab == k)
        if len(rows):
            number[rows] = base + tile_numbers(x[rows], inner)
        base += inner.number() if inner else 1
    return number


def _packed(x: np.ndarray, rows: np.ndarray, leaves: int, dims: int) -> list[np.ndarray]:
    """The rows of every leaf: sorted by the widest coordinate, cut in slabs, and so on within them."""
    if leaves <= 1:
        return [rows]
    own = x[rows]
    along = own[:, int(np.argmax(own.max(0) - own.min(0)))]
    rows, slabs = rows[np.argsort(along, kind="stable")], _slabs(leaves, dims)
    ends = np.cumsum(slabs) * len(rows) // leaves
    return [
        leaf
        for start, end, n in zip([0, *ends[:-1]], ends, slabs, strict=True)
        for leaf in _packed(x, rows[start:end], n, max(1, dims - 1))
    ]


class Tree(NamedTuple):
    """Rows in leaf order; nodes with their boxes, leaves first; the last node is the root.

    ``first`` and ``last`` bound the rows of a leaf, the nodes below any other node.
    """

    x: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    first: np.ndarray
    last: np.ndarray
    leaves: int


def build(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT) -> Tree:
    """An R-tree whose leaves are packed full."""
    groups = _packed(x, np.arange(len(x)), -(-len(x) // leaf_rows), x.shape[1])
    # By id within a leaf: the first of equal scores is that of the smallest id.
    order = np.concatenate([rows[np.argsort(ids[rows], kind="stable")] for rows in groups])
    x = x[order].astype(np.float64)
    ends = np.cumsum([len(rows) for rows in groups])
    first, last = [np.concatenate([[0], ends[:-1]])], [ends]
    lo, hi = [np.minimum.reduceat(x, first[0])], [np.maximum.reduceat(x, first[0])]
    base, n = 0, len(groups)
    while n > 1:
        starts = np.arange(0, n, fanout)
        lo.append(np.minimum.reduceat(lo[-1], starts))
        hi.append(np.maximum.reduceat(hi[-1], starts))
        first.append(base + starts)
        last.append(base + np.minimum(starts + fanout, n))
        base, n = base + n, len(starts)
    return Tree(x, ids[order], labels[order], *map(np.concatenate, (lo, hi, first, last)), len(groups))


def intervals(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of every query with the vectors of every box."""
    above, below = np.maximum(q, 0), np.minimum(q, 0)
    return above @ lo.T + below @ hi.T, above @ hi.T + below @ lo.T


class Queries(NamedTuple):
    """Vectors with id and label, each with windows of scores and what a score must reach in them."""

    x: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray


def useful(low: np.ndarray, high: np.ndarray, floor: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The best score that a box may hold in each window: -inf if outside it or strictly below the floor."""
    best = np.minimum(most, high)
    return np.where((most >= low) & (least <= high) & (best >= floor), best, -np.inf)


def search(tree: Tree, q: Queries, k: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best (score, then smaller id) of each query and window: scores and ids.

    Candidates have the query's label and another id (``same``), or another label. Missing
    ones have the score -inf. Every query has a queue of boxes and opens the best one next.
    """
    m, windows = q.low.shape
    scores, ids = np.full((m, windows, k), -np.inf), np.full((m, windows, k), NO_ID)
    kth = q.floor.copy()
    least, most = intervals(q.x, tree.lo, tree.hi)
    key = np.full(most.shape, -np.inf)
    for w in range(windows):
        np.maximum(key, useful(q.low[:, w, None], q.high[:, w, None], kth[:, w, None], least, most), out=key)
    queue = np.full(key.shape, -np.inf)
    queue[:, -1] = key[:, -1]
    alive = np.arange(m)
    while len(alive):
        node = np.argmax(queue[alive], axis=1)
        bound = queue[alive, node]
        more = (bound > -np.inf) & (bound >= kth[alive].min(1))
        alive, node = alive[more], node[more]
        queue[alive, node] = -np.inf
        order = np.argsort(node, kind="stable")
        edges = np.flatnonzero(np.diff(node[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            box, own = node[order[a]], alive[order[a:b]]
            rows = slice(tree.first[box], tree.last[box])
            if box < tree.leaves:
                _open(tree, rows, q, own, k, same, scores, ids, kth, least[own, box], most[own, box])
            else:
                queue[own, rows] = key[own, rows]
    return scores, ids


def _open(tree, rows, q, own, k, same, scores, ids, kth, least, most) -> None:
    """Score a leaf's rows and keep the best ones."""
    found = q.x[own] @ tree.x[rows].T
    equal = tree.labels[rows] == q.labels[own, None]
    fits = equal & (tree.ids[rows] != q.ids[own, None]) if same else ~equal
    found[~fits] = -np.inf
    for w in range(scores.shape[1]):
        low, high, floor = q.low[own, w], q.high[own, w], kth[own, w]
        wanted = np.flatnonzero(useful(low, high, floor, least, most) > -np.inf)
        if not len(wanted):
            continue
        part = found[wanted]
        part = np.where((part >= np.maximum(low, floor)[wanted, None]) & (part <= high[wanted, None]), part, -np.inf)
        hit = np.flatnonzero(part.max(1) > -np.inf)
        if not len(hit):
            continue
        part, at = part[hit], own[wanted[hit]]
        new_scores, new_ids = np.full((len(at), k), -np.inf), np.full((len(at), k), NO_ID)
        each = np.arange(len(at))
        for j in range(min(k, part.shape[1])):
            best = np.argmax(part, axis=1)
            new_scores[:, j] = part[each, best]
            new_ids[:, j] = np.where(new_scores[:, j] > -np.inf, tree.ids[rows][best], NO_ID)
            part[each, best] = -np.inf
        all_scores = np.concatenate([scores[at, w], new_scores], axis=1)
        all_ids = np.concatenate([ids[at, w], new_ids], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        scores[at, w] = np.take_along_axis(all_scores, order, axis=1)
        ids[at, w] = np.take_along_axis(all_ids, order, axis=1)
        kth[at, w] = np.maximum(kth[at, w], scores[at, w, k - 1])
