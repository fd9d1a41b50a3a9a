"""Mined rows equal a plain search over all rows: ties, repeats, odd rows, many trees."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklab.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, print string, tree string, low string"


def plain(rows, positives=5, negatives=3, window=(50, 95), every=5):
    """Rows (vec_id, integer vector, label) -> sorted result rows."""
    out = []
    for i, (a, va, la) in enumerate(rows):
        if a % every:
            continue
        scored = [(-int(np.dot(va, v)), vid, label) for j, (vid, v, label) in enumerate(rows) if j != i]
        best = sorted(s for s in scored if s[2] == la)[:positives]
        for rank, (ps, pid, _) in enumerate(best, 1):
            ps = -ps
            near = sorted((s, vid) for s, vid, label in scored
                          if label != la and window[0] * ps <= -100 * s <= window[1] * ps)[:negatives]
            out += [(a, rank, pid, ps, k, vid, -s) for k, (s, vid) in enumerate(near, 1)]
    return sorted(out)


def mined(frame, rows, **more):
    df = frame([(a, [x / 256 for x in v], label, "p", "t", "l") for a, v, label in rows], SCHEMA, 4)
    return sorted(tuple(r) for r in H.mine(H.scaled(df), F.col("vec_id") % 5 == 0, **more).collect())


def some_rows(n, dims, labels, spread, seed):
    rng = random.Random(seed)
    return [(i, [rng.randint(-spread, spread) for _ in range(dims)], rng.choice(labels)) for i in range(n)]


@pytest.mark.parametrize("n, dims, labels, spread", [(400, 6, [0, 1, 2], 60), (300, 2, [0, 0, 0, 1], 3), (120, 1, [4, 5], 9), (40, 3, [1], 5)])
def test_equals_plain_search(frame, n, dims, labels, spread):
    rows = some_rows(n, dims, labels, spread, n)
    assert mined(frame, rows) == plain(rows)


def test_many_small_trees_and_leaves(frame, monkeypatch):
    monkeypatch.setattr(H, "TREE_ROWS", 70)
    monkeypatch.setattr(H, "LEAST_TREE_ROWS", 70)
    rows = some_rows(500, 4, [0] * 5 + [1, 2], 12, 7)
    assert mined(frame, rows) == plain(rows)


def test_repeated_rows_and_ids(frame):
    rows = some_rows(60, 3, [0, 1], 4, 1)
    rows += rows[::5] * 3 + [(5, [1, 2, 3], 0), (5, [1, 2, 3], 1)]
    assert mined(frame, rows) == plain(rows)


def test_windows_of_one_score_and_none(frame):
    rows = [(0, [2], 0), (1, [5], 0), (2, [0], 0), (3, [-1], 0), (10, [2], 1), (11, [3], 1), (12, [0], 1), (13, [1], 1)]
    assert mined(frame, rows) == plain(rows)
    assert mined(frame, rows, positives=2, negatives=1, window=(90, 100)) == plain(rows, 2, 1, (90, 100))


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    rows = some_rows(50, 3, [0, 1], 9, 3)
    odd = [(500, None, 0), (505, [1.0, None, 0.0], 0), (510, [nan, 0.0, 0.0], 1), (515, [inf, 0.0, 0.0], 1), (520, [1.0, 1.0, 1.0], None),
           (None, [1.0, 1.0, 1.0], 1)]
    df = frame([(a, [x / 256 for x in v], label, "", "", "") for a, v, label in rows] + [(*r, "", "", "") for r in odd], SCHEMA)
    got = sorted(tuple(r) for r in H.mine(H.scaled(df), F.col("vec_id") % 5 == 0).collect())
    assert got == plain(rows)


def test_lengths_differ(frame):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-9, 9) for _ in range(i % 4)], i % 2) for i in range(80)]
    filled = [(a, v + [0] * (4 - len(v)), label) for a, v, label in rows]
    assert mined(frame, rows) == plain(filled)


def test_large_components(frame):
    rows = [(i, [(i - 20) * 2**21, 2**25 - i, 7], i % 3) for i in range(40)]
    assert mined(frame, rows) == plain(rows)


def test_empty(frame):
    assert H.mine(H.scaled(frame([], SCHEMA, 1)), F.col("vec_id") % 5 == 0).count() == 0
    assert mined(frame, [(1, [1], 0), (2, [1], 1)]) == []


def test_floor_of_scaled(frame):
    df = frame([(1, [-0.001, 0.0039, 0.00390625, -1.0, 1e9], 0, "", "", "")], SCHEMA, 1)
    assert H.scaled(df).first().v == [-1, 0, 1, -256, H.COMPONENT]


def test_boxes_prune():
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (40, 4))
    vectors = np.repeat(centres, 200, axis=0) + rng.integers(-20, 20, (8000, 4))
    tree = H.RTree(np.arange(8000), np.zeros(8000, np.int64), vectors)
    q = vectors[:1]
    search = H.Search(tree, np.array([0]), np.array([0]), q, np.full((1, 1), H.LEAST), np.full((1, 1), H.MOST), True, 3).run()
    want = sorted((-int(s), i) for i, s in enumerate((vectors @ q[0]).tolist()))[:3]
    assert [(-int(s), int(i)) for s, i in zip(search.score[0, 0], search.id[0, 0])] == want
    assert search.visited < 4000
