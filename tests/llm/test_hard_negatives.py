"""R-tree mining against scoring every row, and the tree's own rules."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import hard_negatives, str_tree

SCHEMA = "vec_id long, embedding array<float>, label int, region int, uid string, x double, rank int"


def brute(rows, is_anchor):
    kept = []
    for row_id, vector, label in rows:
        if label is not None and vector and all(c is not None and math.isfinite(c) for c in vector):
            kept.append((math.inf if row_id is None else row_id, [math.floor(256 * c) for c in vector], label))
    score = lambda a, b: sum(x * y for x, y in zip(a[1], b[1], strict=True))
    out = []
    for a in kept:
        if a[0] == math.inf or not is_anchor(a[0]):
            continue
        best = lambda found: sorted((-score(a, b), b[0]) for b in found)
        for ps, positive in best(b for b in kept if b[2] == a[2] and b[0] != a[0])[:5]:
            window = [b for b in kept if b[2] != a[2] and 50 * -ps <= 100 * score(a, b) <= 95 * -ps]
            for rank, (ns, negative) in enumerate(best(window)[:3], 1):
                out.append((a[0], positive, rank, negative, -ps, -ns))
    return sorted(out)


def mined(spark, rows, every):
    frame = spark.createDataFrame([(i, v, label, 1, "clash", 0.5, 9) for i, v, label in rows], SCHEMA)
    found = hard_negatives.mine(frame.repartition(4), F.col("vec_id") % every == 0)
    return sorted(tuple(math.inf if c is None else c for c in r) for r in found.collect())


@pytest.mark.parametrize(("seed", "dims", "spread", "shelves"), [(1, 8, 0.3, 1024), (2, 3, 0.05, 4), (3, 16, 1.0, 1)])
def test_mining_equals_brute_force(spark, monkeypatch, seed, dims, spread, shelves):
    monkeypatch.setattr(hard_negatives, "REGION_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "SAMPLE_ROWS", 200)
    monkeypatch.setattr(hard_negatives, "SHELVES", shelves)
    monkeypatch.setattr(hard_negatives, "QUERY_ROWS", 25)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dims))
    rows = []
    for k in range(700):
        # One vector of many copies under two labels, and steps that make ties.
        vector = centres[0] if k % 3 == 0 else centres[k % 9] + spread * rng.normal(size=dims)
        rows.append((k, [round(float(c), 1) for c in vector], k % 4 if k % 11 else None))
    rows += [rows[8], rows[8], rows[40], (None, rows[4][1], 1), (None, rows[5][1], 2), (3000, None, 1), (3010, [], 1)]
    rows += [(3020, [None] * dims, 2), (3030, [math.nan] * dims, 2), (3040, [-math.inf] * dims, 1)]
    got = mined(spark, rows, 10)
    assert got == brute(rows, lambda i: i % 10 == 0) and len(got) > 100


def test_few_and_no_rows(spark):
    rows = [(50, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.9, 0.0], 2), (100, [1.0, 0.0], 7)]
    assert mined(spark, rows, 50) == brute(rows, lambda i: i % 50 == 0) != []
    assert mined(spark, rows[1:3], 50) == mined(spark, [], 50) == mined(spark, [(50, None, 1)], 50) == []
    with pytest.raises(Exception, match="one length"):
        mined(spark, [*rows, (9, [1.0], 1)], 50)


def test_every_row_lies_in_its_boxes():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (1000, 5))
    tree = str_tree.build(x, np.arange(1000), np.zeros(1000, np.int64), leaf_rows=16, fanout=4)
    assert sorted(tree.ids.tolist()) == list(range(1000)) and (x[tree.ids] == tree.x).all()
    seen = []

    def below(node):
        rows = slice(tree.first[node], tree.last[node])
        if node < tree.leaves:
            seen.append(tree.last[node] - tree.first[node])
            return np.arange(1000)[rows]
        return np.concatenate([below(child) for child in range(*rows.indices(len(tree.lo)))])

    for node in range(len(tree.lo)):
        own = tree.x[below(node)]
        assert (own.min(0) == tree.lo[node]).all() and (own.max(0) == tree.hi[node]).all()
    assert len(below(len(tree.lo) - 1)) == 1000 and max(seen) <= 17
    q = rng.integers(-9, 9, (20, 5)).astype(float)
    least, most = str_tree.intervals(q, tree.lo[-1:], tree.hi[-1:])
    assert (least <= (q @ tree.x.T).min(1, keepdims=True)).all() and (most >= (q @ tree.x.T).max(1, keepdims=True)).all()


def test_queue_opens_few_leaves_in_clustered_rows(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.integers(-500, 500, (40, 8))
    x = np.repeat(centres, 50, axis=0) + rng.integers(-5, 6, (2000, 8))
    labels = np.arange(2000) % 2
    tree = str_tree.build(x, np.arange(2000), labels, leaf_rows=25)
    opened = []
    monkeypatch.setattr(str_tree, "_open", lambda t, rows, q, own, *rest, f=str_tree._open: opened.append(len(own)) or f(t, rows, q, own, *rest))
    at, wide = np.arange(0, 2000, 20), np.full((100, 1), np.inf)
    q = str_tree.Queries(x[at].astype(float), at, labels[at], -wide, wide, -wide)
    scores, ids = str_tree.search(tree, q, 5, True)
    for k, row in enumerate(at):
        other = [i for i in range(2000) if i % 2 == row % 2 and i != row]
        want = sorted((-int(x[row] @ x[i]), i) for i in other)[:5]
        assert [(-int(s), i) for s, i in zip(scores[k, 0], ids[k, 0].tolist(), strict=True)] == want
    assert sum(opened) < 0.35 * 100 * tree.leaves


def test_tiles_deal_rows_evenly():
    x = np.random.default_rng(3).integers(-1000, 1000, (5000, 6))
    tiles = str_tree.tiles_of(x, 13)
    sizes = np.bincount(str_tree.tile_numbers(x, tiles), minlength=13)
    assert len(sizes) == tiles.number() == 13 and sizes.min() > 0.7 * 5000 / 13 and sizes.max() < 1.3 * 5000 / 13
    same = np.zeros((100, 6), int)
    assert len(np.unique(str_tree.tile_numbers(same, str_tree.tiles_of(same, 4)))) == 1
