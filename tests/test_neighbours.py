"""The pruned neighbour join equals all pairs: clusters, ties, hot cells, few rows."""

import numpy as np
import pytest

from tracklab.operators import knn
from tracklab.operators.small import literal_table


def frames(spark, points, queries, labels=None):
    train = [(i, p.tolist(), int(0 if labels is None else labels[i])) for i, p in enumerate(points)]
    asked = [(f"q{i}", q.tolist()) for i, q in enumerate(queries)]
    return (literal_table(spark, asked, "id string, x array<double>").repartition(3),
            literal_table(spark, train, "id long, x array<double>, label int").repartition(3))


def plain(points, queries, k):
    out = {}
    for i, q in enumerate(queries):
        d = ((points - q) ** 2).sum(axis=1)
        out[f"q{i}"] = [(int(j), pytest.approx(d[j])) for j in sorted(range(len(points)), key=lambda j: (d[j], j))[:k]]
    return out


def joined(spark, points, queries, k, **more):
    q, t = frames(spark, points, queries)
    out = {}
    for r in knn.neighbours(q, t, k, **more).collect():
        out.setdefault(r["id"], []).append((r["distance"], r["neighbour"]))
    return {i: [(n, d) for d, n in sorted(rows)] for i, rows in out.items()}


def test_clusters_are_pruned(spark):
    rng = np.random.default_rng(1)
    points = (rng.normal(size=(30, 1, 6)) * 40 + rng.normal(size=(30, 40, 6))).reshape(-1, 6)
    queries, course = points[::17] + rng.normal(size=points[::17].shape) * 0.3, {}
    assert joined(spark, points, queries, 7, course=course, block_rows=25) == plain(points, queries, 7)
    assert course["pairs"] == len(points) * len(queries) and course["compared"] < 0.3 * course["pairs"]


@pytest.mark.parametrize("pivots", [1, 3, 40])
def test_ties_and_repeated_points(spark, monkeypatch, pivots):
    monkeypatch.setattr(knn, "PART_ROWS", 7)
    rng = np.random.default_rng(2)
    points = rng.integers(0, 3, (150, 2)).astype(float)
    points[:60] = [1.0, 1.0]
    queries = rng.integers(-1, 4, (40, 2)) / 2
    assert joined(spark, points, queries, 5, pivots=pivots, block_rows=11) == plain(points, queries, 5)


def test_fewer_rows_than_neighbours(spark):
    points, queries = np.array([[0.0], [2.0], [2.0]]), np.array([[1.0], [5.0]])
    assert joined(spark, points, queries, 7) == plain(points, queries, 7)
    q, t = frames(spark, points, queries)
    assert knn.neighbours(q, t.limit(0), 3).count() == 0 and knn.neighbours(q.limit(0), t, 3).count() == 0


def test_rough_candidates_never_decide():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(500, 3)) * 1e-7 + 1000.0  # rounding of the matrix product is above all distances
    queries = points[:20]
    near, distance = knn._nearest(queries, points, 6)
    for i, q in enumerate(queries):
        d = ((points - q) ** 2).sum(axis=1)
        assert near[i].tolist() == sorted(range(500), key=lambda j: (d[j], j))[:6] and distance[i] == pytest.approx(np.sort(d)[:6])


def test_votes():
    labels, use = np.array([[2.0, 1.0, 1.0], [3.0, 2.0, 9.0], [1.0, 1.0, 1.0]]), np.array([[1, 1, 1], [1, 1, 0], [0, 0, 0]], bool)
    got = knn._vote(labels, use)
    assert got[:2].tolist() == [1.0, 2.0] and np.isnan(got[2])


def test_vote_does_not_depend_on_the_order_of_rows(spark):
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(4)
    rows = [(float(rng.integers(0, 3)), Vectors.dense(rng.integers(0, 2, 2).astype(float))) for _ in range(60)]
    df = spark.createDataFrame(rows, ["label", "features"])
    votes = [sorted((tuple(r.features), r.prediction) for r in knn.KnnClassifier(k=5).fit(d).transform(df).collect())
             for d in (df, df.repartition(5), df.orderBy("label"))]
    assert votes[0] == votes[1] == votes[2]


def test_blocks_do_not_multiply_the_queries(spark, monkeypatch):
    """What is dealt to tasks does not grow with the blocks of a cell: rows are sent once per group of queries."""
    rng = np.random.default_rng(5)
    points = literal_table(spark, [(i, p, float(i % 3)) for i, p in enumerate(rng.normal(size=(700, 4)).tolist())], "id long, x array<double>, label double")
    dealt, plain_deal, frame = [], type(points).repartition, type(points)
    monkeypatch.setattr(frame, "repartition", lambda self, *a: dealt.append(self.count()) or plain_deal(self, *a))
    results, totals = [], []
    for block_rows in (700, 4):
        dealt.clear()
        found = knn.neighbours(points.select("id", "x"), points, 5, leave_one_out=True, block_rows=block_rows)
        results.append(sorted(map(tuple, found.collect())))
        totals.append(sum(dealt))
    assert results[0] == results[1] and totals[0] == totals[1]


def test_groups_are_of_near_cells_and_bounded(monkeypatch):
    monkeypatch.setattr(knn, "PART_ROWS", 10)
    groups = knn._groups([2, 0, 3, 1, 4], {0: 4, 1: 25, 2: 5, 4: 3}, 1)
    assert groups == [(2, 0, 1), (0, 0, 1), (1, 1, 3), (4, 4, 1)]
    assert knn._groups([], {}, 8) == []
