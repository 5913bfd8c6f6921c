"""Ball k-means codes against comparing every part with every entry."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from curbline.llm import ball_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int, owners int"


def brute(rows, parts, entries, rounds):
    """(id, label, code, error) of every kept row, and the codebooks; plain Python integers."""
    kept = []
    for row_id, vector, label in rows:
        if vector and all(c is not None and math.isfinite(c) for c in vector):
            kept.append((row_id, label, [math.floor(256 * c) for c in vector]))
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][2]))[:entries]
    books = [[list(cut[i][p]) for i in order] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [[min(range(len(books[p])), key=lambda e: (far(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        codes, members = assign(), defaultdict(list)
        for c, code in zip(cut, codes, strict=True):
            for p, e in enumerate(code):
                members[p, e].append(c[p])
        for (p, e), own in members.items():
            books[p][e] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = []
    for (row_id, label, _), c, code in zip(kept, cut, assign(), strict=True):
        found.append((row_id, label, bytes(code), sum(far(c[p], books[p][e]) for p, e in enumerate(code))))
    return found, books


def spread(rows):
    return [(row_id, vector, label, "clash", 1, 2) for row_id, vector, label in rows]


@pytest.mark.parametrize(("seed", "step"), [(1, 1 / 256), (2, 1 / 16), (3, 1 / 4)])
def test_codes_equal_brute_force(spark, seed, step):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows = []
    for k in rng.permutation(400):
        # Coarse steps make many ties.
        vector = np.round((centres[k % 12] + 0.4 * rng.normal(size=16)) / step) * step
        rows.append((int(k), [float(np.float32(c)) for c in vector], [0, 1, None][k % 3]))
    rows += [rows[0], rows[0], (None, rows[3][1], 7), (500, None, 1), (501, [], 1), (502, [1.0] * 15 + [None], 1)]
    rows += [(503, [math.inf] + [0.0] * 15, 1), (504, [math.nan] * 16, None)]
    found = ball_codes.compress(spark.createDataFrame(spread(rows), SCHEMA).repartition(5), parts=4, entries=20)
    want, books = brute(rows, 4, 20, 2)
    assert found.codebooks.entries.tolist() == books
    by_label = defaultdict(int)
    for _, label, _, error in want:
        by_label[label] += error
    got = sorted((str(r["vec_id"]), str(r["label"]), bytes(r["code"]), r["error"], r["label_error"]) for r in found.rows.collect())
    assert got == sorted((str(i), str(label), code, error, by_label[label]) for i, label, code, error in want)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.5, -0.001], 1), (2, [0.5, 0.25], None), (3, None, 1)]
    found = ball_codes.compress(spark.createDataFrame(spread(rows), SCHEMA), parts=2)
    assert found.codebooks.entries.tolist() == [[[128], [128]], [[-1], [64]]]
    assert {(r["vec_id"], bytes(r["code"]), r["label_error"]) for r in found.rows.collect()} == {(1, b"\0\0", 0), (2, b"\0\1", 0)}
    for none in ([], rows[2:]):
        empty = ball_codes.compress(spark.createDataFrame(spread(none), SCHEMA), parts=2)
        assert empty.rows.count() == 0 and empty.rows.columns == found.rows.columns
    with pytest.raises(ValueError, match="equal parts"):
        ball_codes.compress(spark.createDataFrame(spread(rows), SCHEMA), parts=3)
    with pytest.raises(ValueError, match="entries"):
        ball_codes.compress(spark.createDataFrame(spread(rows), SCHEMA), entries=300)


def test_stable_cores_and_rings_skip_distances():
    rng = np.random.default_rng(4)
    book = rng.integers(-200, 200, (64, 4))
    x = book[rng.integers(0, 64, 5000)] + rng.integers(-25, 26, (5000, 4))
    owners = ball_codes.nearest(x, book)
    later = book + rng.integers(-3, 4, book.shape)
    reach = np.zeros(64)
    np.maximum.at(reach, owners, np.sqrt(ball_codes.squared(x, book[owners])))
    radii = reach + np.sqrt(ball_codes.squared(book, later))
    new, own, measured = ball_codes.moved(x, owners, later, ball_codes.neighbours(later, radii))
    assert (new == ball_codes.nearest(x, later)).all() and (own == ball_codes.squared(x, later[new])).all()
    assert measured < 0.2 * 5000 * 64
