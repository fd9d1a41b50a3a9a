"""What queries write, shuffle and hold: bounds that larger tables need."""

import os
import tempfile

import numpy as np
from pyspark.ml.functions import array_to_vector

from tracklab.operators import forest, knn, learning, metrics, ordered, split
from tracklab.operators.forest import Forest, Growth, grown
from tracklab.operators.small import literal_table
from tracklab.plans import queries_train, training
from tracklab.plans.catalogue import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_reloads_are_compared_row_by_row_without_a_join(spark, sf):
    for name in ("preprocessor_reload", "reload_equality"):
        assert plan(QUERIES[name](spark, sf)).count("Relation [l_orderkey") == 1


def test_preparing_writes_the_narrow_rows_once(spark, sf, monkeypatch, tmp_path):
    staged = []

    def stage(df, purpose):
        staged.append(purpose)
        return df.localCheckpoint()

    def made(spark, purpose, key, make):
        make(str(tmp_path / purpose))
        return str(tmp_path / purpose)

    monkeypatch.setattr(queries_train, "kept", made)
    monkeypatch.setattr(split, "stage", stage)
    monkeypatch.setattr(training, "stage", stage)
    prepared = queries_train._prepared(spark, sf)
    assert staged == []
    assert set(spark.read.parquet(str(tmp_path / "prepared/rows")).columns) == {"track_id", "signal_genre", *training.S.FEATURES}
    assert prepared.rows.columns == ["track_id", "signal_genre", "split", "label", "features"]
    assert prepared.rows.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()


def test_scoring_invariants_join_nothing(spark, sf):
    assert plan(QUERIES["scoring_invariants"](spark, sf)).count("Relation [l_orderkey") == 1


def test_forest_of_millions_of_rows_grows_from_packed_blocks():
    assert Forest().getOrDefault("oneTableRows") >= 6 * 600_000 * 0.85


def test_trees_do_not_depend_on_the_rows_of_a_step(monkeypatch):
    rng = np.random.default_rng(3)
    bins, label = rng.integers(0, 8, (900, 5)).astype(np.uint8), rng.integers(0, 3, 900)
    g = Growth(3, 8, 6, 1, 2, 3, 5)
    whole = grown(bins, label, [list(map(float, range(7)))] * 5, g, 1).packed()
    monkeypatch.setattr(forest, "PIECE", 7)
    assert grown(bins, label, [list(map(float, range(7)))] * 5, g, 1).packed() == whole


def test_nodes_counted_alone_and_together_split_alike(monkeypatch):
    rng = np.random.default_rng(4)
    bins, label = rng.integers(0, 8, (3000, 5)).astype(np.uint8), rng.integers(0, 3, 3000)
    edges, g = [list(map(float, range(7)))] * 5, Growth(3, 8, 9, 2, 4, 3, 5)
    trees = []
    for large in (1, 100, 10_000):
        monkeypatch.setattr(forest, "LARGE", large)
        trees.append(grown(bins, label, edges, g, 2).packed())
    assert len(set(trees)) == 1
    tree = forest.Tree.unpacked(trees[0], 3)
    inner = tree.feature >= 0
    assert np.array_equal(tree.counts[inner], tree.counts[tree.left[inner]] + tree.counts[tree.right[inner]])


def test_rows_are_binned_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(forest, "EXACT_EDGES", 10)
    rows = spark.range(400).selectExpr("cast(id % 3 as double) as label", "array(double(id % 7), double(id)) as x").select(
        "label", array_to_vector("x").alias("features"))
    seen, sort = [], type(rows).orderBy
    monkeypatch.setattr(type(rows), "orderBy", lambda self, *a, **b: seen.append(a) or sort(self, *a, **b))
    dealt = [Forest(numTrees=3).fit(rows.repartition(n)).trees for n in (1, 5)]
    assert seen == []
    assert [t.packed() for t in dealt[0]] == [t.packed() for t in dealt[1]]


def test_forest_of_a_mapped_file_is_that_of_the_broadcast_table(spark, monkeypatch, tmp_path):
    """Of more rows than are broadcast, the executor's tasks share a file; the trees are the same and it is removed."""
    assert Forest().getOrDefault("oneTableRows") >= 60 * 600_000 * 0.85
    monkeypatch.setattr(forest, "EXACT_EDGES", 10)
    rows = spark.range(900).selectExpr("cast(id % 3 as double) as label", "array(double(id % 7), double(id), double(id % 11)) as x").select(
        "label", array_to_vector("x").alias("features")).repartition(5)
    first, named, removed = Forest(numTrees=4).fit(rows), [], forest.unmapped
    monkeypatch.setattr(forest, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(forest, "unmapped", lambda spark, name: named.append(name) or removed(spark, name))
    for bins in (32, 200):
        plain = first if bins == 32 else None
        model = Forest(numTrees=4, maxBins=bins).fit(rows)
        if plain:
            assert [t.packed() for t in model.trees] == [t.packed() for t in plain.trees]
        assert all(t.counts[0].sum() == 900 for t in model.trees)
    assert len(named) == 2 and not [p for p in os.listdir(tempfile.gettempdir()) if p.startswith(tuple(named))]


def test_nodes_and_stored_trees(spark, tmp_path):
    rows = spark.range(300).selectExpr("cast(id % 3 as double) as label", "array(double(id % 7), double(id % 50)) as x").select(
        "label", array_to_vector("x").alias("features"))
    model = Forest(numTrees=3).fit(rows)
    nodes = model.node_table(spark).orderBy("tree", "node").collect()
    assert [tuple(r) for r in nodes] == [(i, n, f, c, a, b, k) for i, t in enumerate(model.trees) for n, (f, c, a, b, k) in enumerate(
        zip(t.feature.tolist(), t.threshold.tolist(), t.left.tolist(), t.right.tolist(), t.counts.sum(axis=1).tolist()))]
    # Models that were stored before trees were compressed are read as they are.
    literal_table(spark, [(i, t.packed()) for i, t in enumerate(model.trees)], "tree int, nodes binary").write.parquet(str(tmp_path / "old/trees"))
    model.save_tables(spark, str(tmp_path / "new"))
    for name in ("old", "new"):
        other = forest.ForestModel()
        other.classes = model.classes
        other.load_tables(spark, str(tmp_path / name))
        assert [t.packed() for t in other.trees] == [t.packed() for t in model.trees]


def test_vectors_are_unpacked_once_per_row(spark, sf):
    for name in ("scaled_inputs", "fixed_tree_proba"):
        assert plan(QUERIES[name](spark, sf)).count("UDF(") <= 4


def test_scores_are_staged_without_a_table_of_all_scores(spark, sf, monkeypatch):
    staged = []
    monkeypatch.setattr(metrics, "stage", lambda df, purpose: staged.append(plan(df)) or df.localCheckpoint())
    QUERIES["macro_auc"](spark, sf)
    assert len(staged) == 1 and "Aggregate" not in staged[0]


def test_running_totals_bring_ties_together_in_tasks_of_bounded_size(spark, monkeypatch):
    rows = spark.range(5000).selectExpr("concat('k', id % 3) as k", "if(id % 4 = 0, 0D, double(id * 37 % 1009)) as x", "id % 5 as n").union(
        spark.sql("select 'rare', 7D, 1L")).localCheckpoint()
    whole = ordered.running_totals(rows, ["k"], "x", {"upto": "n"}, None, ["n"])
    monkeypatch.setattr(ordered, "TASK_ROWS", 100)
    monkeypatch.setattr(ordered, "SPLIT_ROWS", 900)
    parts = ordered.running_totals(rows, ["k"], "x", {"upto": "n"}, 0, ["n"])
    assert sorted(map(tuple, parts.select("k", "x", "n", "upto").collect())) == sorted(map(tuple, whole.select("k", "x", "n", "upto").collect()))
    assert whole.count() == whole.select("k", "x").distinct().count()
    assert "RepartitionByExpression" in plan(parts) and ", 51" in plan(parts)


def test_rows_without_a_truth_count_for_no_class(spark):
    rows = spark.sql("select * from values ('a', 0.9D), ('b', 0.9D), ('b', 0.2D), ('a', 0.1D), (null, 0.5D), (null, 0.95D) as t(y_true, p)")
    known = rows.filter("y_true is not null")
    for n in (None, 0):
        got, want = (metrics.auc_per_class(r, {"a": "p"}, plain_rows=n).first()["auc"] for r in (rows, known))
        assert got == want == 0.375


def leaf_of(tree, row):
    node = 0
    while tree.feature[node] >= 0:
        node = tree.left[node] if row[tree.feature[node]] <= tree.threshold[node] else tree.right[node]
    return node


def test_scorer_walks_as_the_trees_say_and_is_small():
    rng = np.random.default_rng(6)
    bins, label = rng.integers(0, 8, (4000, 5)).astype(np.uint8), rng.integers(0, 3, 4000)
    g = Growth(3, 8, 12, 1, 2, 3, 5)
    trees = [grown(bins, label, [list(map(float, range(7)))] * 5, g, k) for k in range(5)]
    other = trees[0]._replace(left=trees[0].right, right=trees[0].left)  # children in any order
    x = rng.uniform(-1, 8, (300, 5))
    x[::7, 2], x[::5] = np.nan, np.round(x[::5])
    for some in (trees, [other], [trees[0]._replace(feature=np.array([-1]), threshold=np.array([np.inf]), left=np.array([0]), right=np.array([0]), counts=np.array([[1.0, 3, 0]]))]):
        want = np.mean([[t.counts[n] / t.counts[n].sum() for n in (leaf_of(t, r) for r in x)] for t in some], axis=0)
        assert np.allclose(forest.Scorer(some).chances(x), want, rtol=0, atol=1e-12)
    scorer = forest.Scorer(trees)
    held = scorer.share.nbytes + scorer.walker["nodes"].nbytes
    assert held <= 12 * sum(len(t.feature) for t in trees)


def test_a_row_is_scored_once_for_its_playlists(spark, sf):
    plan = QUERIES["fixed_tree_recommendations"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython ") == 1


def test_sketched_edges_are_near_the_exact_ones(spark, monkeypatch):
    x = np.random.default_rng(2).normal(size=(6000, 2))
    table = literal_table(spark, [(r,) for r in x.tolist()], "x array<double>").repartition(3)
    monkeypatch.setattr(learning, "SKETCH_POINTS", 200)
    monkeypatch.setattr(learning, "SKETCH_ROWS", 700)
    rank = [np.sort(x[:, i]).searchsorted(e) for i, e in enumerate(learning.bin_edges(table, 2, 32))]
    for r in rank:
        assert len(r) == 31 and abs(r - 6000 * np.arange(1, 32) / 32).max() <= 6000 / 200 + 1


def test_brackets_of_whole_columns_are_not_joined(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("if(id % 10 = 0, null, double(id * 7919 % 3001)) as a", "int(id % 2) as b", "cast(null as double) as c")
    monkeypatch.setattr(ordered, "range_of", None)
    got = {(r["feature"], r["prob"]): r["value"] for r in ordered.quantiles(rows, ["a", "b", "c"], [0.25, 0.5], percentile_rows=0).collect()}
    a = [r["a"] for r in rows.collect() if r["a"] is not None]
    assert set(got) == {(c, p) for c in "ab" for p in (0.25, 0.5)}
    assert [got["a", p] for p in (0.25, 0.5)] == [float(np.quantile(a, p)) for p in (0.25, 0.5)] and got["b", 0.5] == 0.5


def test_rows_beyond_the_kth_distance_are_not_kept(spark, monkeypatch):
    rng = np.random.default_rng(8)
    points = literal_table(spark, [(i, p, 0) for i, p in enumerate(rng.normal(size=(900, 3)).tolist())], "id long, x array<double>, label int")
    met, meet = [], knn._meet
    monkeypatch.setattr(knn, "_meet", lambda asked, *a: met.append((asked, meet(asked, *a).localCheckpoint())) or met[-1][1])
    best = knn.neighbours(points.select("id", "x"), points, 3, leave_one_out=True, block_rows=50)
    assert best.groupBy("id").count().filter("count <> 3").count() == 0
    visits, kept = met[1][0].count(), met[1][1].count()
    assert visits > 0 and kept < 1.5 * visits
