"""The library's own learners against plain versions and optimality conditions on small rows."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tracklab.operators.boosting import JointBoosting, JointBoostingModel
from tracklab.operators.forest import Forest, ForestModel, Growth, Tree, grown
from tracklab.operators.learning import bin_edges, binned, labelled
from tracklab.operators.perceptron import Net, Perceptron, PerceptronModel
from tracklab.operators.svm import SquaredHingeSVC, SquaredHingeSVCModel


def table(spark, x, y):
    return spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x.tolist(), y.tolist())], ["label", "features"]) \
        .repartition(3)


def blobs(n, features, classes, seed, noise=1.5):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    x = rng.normal(size=(classes, features))[y] * 2 + rng.normal(size=(n, features)) * noise
    return np.round(x * 1.2), y


@pytest.fixture(scope="module")
def rows(spark):
    x, y = blobs(500, 4, 3, 1)
    return x, y, table(spark, x, y).cache()


def plain_boosting(x, y, rounds, rate, leaves, depth, least, alpha, penalty):
    """Leaf-wise boosting by trying every threshold of every feature, a tree per class and round."""
    k, n = y.max() + 1, len(y)
    scores = np.tile(np.log(np.bincount(y) / n), (n, 1))
    trees = []

    def soft(g):
        return math.copysign(max(abs(g) - alpha, 0), g)

    def worth(g, h):
        return soft(g) ** 2 / (h + penalty)

    def best(at, g, h):
        found = None
        for f in range(x.shape[1]):
            for cut in np.unique(x[at, f])[:-1]:
                low = at[x[at, f] <= cut]
                high = at[x[at, f] > cut]
                if min(len(low), len(high)) >= least and min(h[low].sum(), h[high].sum()) >= 1e-3:
                    gain = worth(g[low].sum(), h[low].sum()) + worth(g[high].sum(), h[high].sum()) - worth(g[at].sum(), h[at].sum())
                    if gain > 1e-9 and (found is None or gain > found[0] * (1 + 1e-9)):
                        found = gain, f, cut, low, high
        return found

    for _ in range(rounds):
        p = np.exp(scores)
        p /= p.sum(axis=1, keepdims=True)
        for c in range(k):
            g, h = p[:, c] - (y == c), p[:, c] * (1 - p[:, c]) * k / (k - 1)
            open_leaves, cuts = [(np.arange(n), 0)], []
            while len(open_leaves) < leaves:
                options = [(best(at, g, h), i) for i, (at, d) in enumerate(open_leaves) if not depth or d < depth]
                options = [(o, i) for o, i in options if o]
                if not options:
                    break
                (gain, f, cut, low, high), i = max(options, key=lambda o: o[0][0])
                d = open_leaves.pop(i)[1] + 1
                open_leaves += [(low, d), (high, d)]
                cuts.append((f, cut))
            values = []
            for at, _ in open_leaves:
                values.append(-rate * soft(g[at].sum()) / (h[at].sum() + penalty))
                scores[at, c] += values[-1]
            trees.append((sorted(cuts), sorted(values)))
    return trees, scores


CASES = [dict(leaves=5, depth=0, least=10, alpha=0.0, penalty=0.0), dict(leaves=8, depth=2, least=20, alpha=0.7, penalty=1.5)]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("one_task_rows", [10_000, 10])
def test_boosting_equals_plain(rows, case, one_task_rows):
    x, y, df = rows
    rounds = 12 if one_task_rows > 10 else 11  # more than the trees that are replayed
    model = JointBoosting(maxIter=rounds, stepSize=0.3, numLeaves=case["leaves"], maxDepth=case["depth"], minInstancesPerNode=case["least"],
                          regAlpha=case["alpha"], regLambda=case["penalty"], oneTaskRows=one_task_rows).fit(df)
    trees, scores = plain_boosting(x, y, rounds, 0.3, case["leaves"], case["depth"], case["least"], case["alpha"], case["penalty"])
    got = {}
    for r in model.nodes:
        cuts, values = got.setdefault((r[0], r[1]), ([], []))
        if r[3] >= 0:
            cuts.append((r[3], r[4]))
        else:
            values.append(r[7])
    for (cuts, values), key in zip(trees, sorted(got)):
        assert sorted(got[key][0]) == cuts and sorted(got[key][1]) == pytest.approx(values, abs=1e-9)
    e = np.exp(scores)
    want = {tuple(a): tuple(b) for a, b in zip(x.tolist(), (e / e.sum(axis=1, keepdims=True)).tolist())}
    for r in model.transform(df).collect():
        assert r.probability.toArray() == pytest.approx(want[tuple(r.features.toArray())], abs=1e-9)
        assert r.prediction == r.probability.argmax()


CHANGES = [dict(maxIter=7), dict(stepSize=0.2), dict(numLeaves=5), dict(numLeaves=6), dict(maxDepth=2), dict(minInstancesPerNode=60),
           dict(subsamplingRate=0.7), dict(columnsRate=0.5), dict(regAlpha=1.0), dict(regLambda=3.0), dict(maxBins=4)]


def test_every_parameter_changes_the_trees(rows):
    _, _, df = rows
    base = dict(maxIter=6, stepSize=0.1, numLeaves=7, minInstancesPerNode=5)
    first = JointBoosting(**base).fit(df).nodes
    assert JointBoosting(**base).fit(df.repartition(1)).nodes == first
    assert all(JointBoosting(**{**base, **change}).fit(df).nodes != first for change in CHANGES)
    assert JointBoosting(**base, subsamplingRate=0.7, seed=1).fit(df).nodes != JointBoosting(**base, subsamplingRate=0.7, seed=2).fit(df).nodes


def test_boosting_of_one_class_and_no_rows(spark):
    df = table(spark, np.arange(8.0).reshape(4, 2), np.zeros(4, int))
    model = JointBoosting(maxIter=2).fit(df)
    assert {r.prediction for r in model.transform(df).collect()} == {0.0}
    with pytest.raises(ValueError):
        JointBoosting().fit(df.limit(0))


def test_boosting_node_table_and_missing_values(spark, rows, tmp_path):
    _, _, df = rows
    model = JointBoosting(maxIter=4, numLeaves=4).fit(df)
    nodes = model.node_table(spark)
    per_tree = nodes.groupBy("round", "class").agg(F.count_if(F.col("feature") >= 0).alias("cuts"), F.count_if(F.col("feature") < 0).alias("leaves"))
    assert per_tree.filter("leaves = cuts + 1").count() == 4 * 3
    model.save(str(tmp_path / "m"))
    again = JointBoostingModel.load(str(tmp_path / "m"))
    odd = table(spark, np.array([[math.nan, 0.0, 1.0, math.inf]]), np.array([0]))
    assert [m.transform(odd).first().probability for m in (model, again)][0] == again.transform(odd).first().probability


def test_svm_is_at_the_optimum(spark):
    x, y = blobs(400, 5, 4, 2, noise=3.0)
    model = SquaredHingeSVC(cost=0.7).fit(table(spark, x, y))
    full = np.hstack([x, np.ones((len(x), 1))])
    for c, w in enumerate(model.weights):
        sign = np.where(y == c, 1.0, -1.0)
        slack = np.maximum(0, 1 - sign * (full @ w))
        gradient = w - 2 * 0.7 * full.T @ (slack * sign)
        assert np.linalg.norm(gradient) < 1e-6  # the objective is 1-strongly convex: so close is w to the optimum


def test_svm_round_trip_and_ties(spark, tmp_path):
    x, y = blobs(60, 2, 2, 3)
    df = table(spark, x, y)
    model = SquaredHingeSVC().fit(df)
    model.save(str(tmp_path / "svm"))
    again = SquaredHingeSVCModel.load(str(tmp_path / "svm"))
    a, b = (m.transform(df).select("features", "prediction", "rawPrediction").orderBy("features").collect() for m in (model, again))
    assert a == b and all(r.prediction == r.rawPrediction.toArray().argmax() for r in a)
    model.weights = np.zeros((2, 3))
    assert {r.prediction for r in model.transform(df).collect()} == {0.0}
    with pytest.raises(ValueError):
        SquaredHingeSVC().fit(df.limit(0))


def test_perceptron_gradient_is_the_slope():
    rng = np.random.default_rng(4)
    net = Net((5, 7, 6, 3))
    weights, x, y = rng.normal(size=net.size), rng.normal(size=(20, 5)), rng.integers(0, 3, 20)
    gradient, loss = net.gradient(weights, x, y)
    for i in rng.choice(net.size, 40, replace=False):
        step = np.zeros(net.size)
        step[i] = 1e-6
        slope = (net.gradient(weights + step, x, y)[1] - net.gradient(weights - step, x, y)[1]) / 2e-6
        assert gradient[i] == pytest.approx(slope, abs=1e-4)
    assert loss == pytest.approx(-np.log(net.chances(weights, x)[np.arange(20), y]).sum())
    assert np.count_nonzero(net.penalised(np.ones(net.size))) == 5 * 7 + 7 * 6 + 6 * 3


def test_perceptron_learns_and_stops_on_noise(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 2))
    y = ((x[:, 0] * x[:, 1]) > 0).astype(int)
    df = table(spark, x, y).cache()
    model = Perceptron(hidden=[32, 16], maxIter=150, stepSize=0.01).fit(df)
    assert model.transform(df).filter("prediction = label").count() > 1400 and max(model.course) > 0.9
    noise = Perceptron(hidden=[16], maxIter=200, stepSize=0.01).fit(table(spark, x, rng.integers(0, 2, 1500)))
    assert len(noise.course) < 100 and max(noise.course) < 0.7


def test_perceptron_in_one_task_equals_jobs(spark):
    x, y = blobs(300, 3, 3, 6)
    df = table(spark, x, y).cache()
    a, b = (Perceptron(hidden=[8], maxIter=3, oneTaskRows=rows).fit(df) for rows in (10_000, 10))
    assert a.weights == pytest.approx(b.weights, abs=1e-9) and a.course == pytest.approx(b.course)


def test_perceptron_parameters_matter(spark, tmp_path):
    x, y = blobs(300, 3, 3, 7)
    df = table(spark, x, y).cache()
    base = dict(hidden=[8, 4], maxIter=4)
    first = Perceptron(**base).fit(df)
    assert (Perceptron(**base).fit(df.repartition(1)).weights == first.weights).all()
    for change in (dict(stepSize=0.1), dict(penalty=5.0), dict(seed=1), dict(hidden=[9]), dict(heldOut=0.3)):
        other = Perceptron(**{**base, **change}).fit(df).weights
        assert len(other) != len(first.weights) or (other != first.weights).any()
    assert len(Perceptron(hidden=[4], maxIter=50, heldOut=0.0).fit(df).course) <= 50
    first.save(str(tmp_path / "mlp"))
    rows, again = (m.transform(df).select("prediction", "probability").collect() for m in (first, PerceptronModel.load(str(tmp_path / "mlp"))))
    assert rows == again and all(abs(r.probability.toArray().sum() - 1) < 1e-9 for r in rows)
    with pytest.raises(ValueError):
        Perceptron().fit(df.limit(0))


def plain_tree(x, y, rows, draws, k, leaf, split, depth):
    """A tree by trying every threshold of the drawn features, nodes in order of their level."""
    open_nodes, nodes, level = [(np.array(rows), 0)], [], 0
    while open_nodes:
        grown_nodes = [(i, at) for i, (at, _) in enumerate(open_nodes) if len(at) >= max(split, 2 * leaf) and len(set(y[at])) > 1 and level < depth]
        features = draws(len(grown_nodes)) if grown_nodes else []
        following, shown = [], {}
        for (i, at), drawn in zip(grown_nodes, features):
            def worth(part):
                return (np.bincount(y[part], minlength=k) ** 2).sum() / len(part)

            best = None
            for f in drawn:
                for cut in np.unique(x[at, f])[:-1]:
                    low, high = at[x[at, f] <= cut], at[x[at, f] > cut]
                    if min(len(low), len(high)) >= leaf:
                        gain = worth(low) + worth(high) - worth(at)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-6):
                            best = gain, f, cut, low, high
            if best:
                shown[i] = (int(best[1]), float(best[2]))
                following += [(best[3], level + 1), (best[4], level + 1)]
        nodes += [(shown.get(i), np.bincount(y[at], minlength=k).tolist()) for i, (at, _) in enumerate(open_nodes)]
        open_nodes, level = following, level + 1
    return nodes


@pytest.mark.parametrize("leaf, split, depth, drawn", [(1, 2, 4, 2), (5, 2, 9, 4), (2, 30, 9, 3)])
def test_forest_trees_equal_plain(leaf, split, depth, drawn):
    x, y = blobs(300, 4, 3, 8)
    edges = [sorted(set(x[:, i].tolist())) for i in range(4)]
    bins = binned(x, edges)
    g = Growth(3, 64, depth, leaf, split, drawn, 11)
    tree = grown(bins, y, edges, g, 5)
    rng = np.random.default_rng([11, 5])
    rows = np.sort(rng.integers(0, 300, 300))
    want = plain_tree(x, y, rows, lambda n: rng.random((n, 4)).argsort(axis=1)[:, :drawn], 3, leaf, split, depth)
    got = [((int(f), float(c)) if f >= 0 else None, k.astype(int).tolist()) for f, c, k in zip(tree.feature, tree.threshold, tree.counts)]
    assert got == want
    assert Tree.unpacked(tree.packed(), 3).counts.tolist() == tree.counts.tolist()


def test_forest_scores_and_round_trip(spark, rows, tmp_path):
    x, y, df = rows
    model = Forest(numTrees=12, maxDepth=5, seed=3).fit(df)
    assert (Forest(numTrees=12, maxDepth=5, seed=3).fit(df.repartition(1)).trees[7].threshold == model.trees[7].threshold).all()

    def walk(tree, row):
        at = 0
        while tree.feature[at] >= 0:
            at = tree.left[at] if row[tree.feature[at]] <= tree.threshold[at] else tree.right[at]
        return tree.counts[at] / tree.counts[at].sum()

    model.save(str(tmp_path / "forest"))
    again = ForestModel.load(str(tmp_path / "forest"))
    for m in (model, again):
        for r in m.transform(df.limit(40)).collect():
            want = np.mean([walk(t, r.features.toArray()) for t in model.trees], axis=0)
            assert r.probability.toArray() == pytest.approx(want) and r.prediction == r.probability.argmax()
    nodes = model.node_table(spark)
    leaves = sum(int((t.feature < 0).sum()) for t in model.trees)
    assert nodes.filter("feature >= 0").count() == leaves - 12 and nodes.filter("node = 0").agg(F.sum("rows")).first()[0] == 12 * 500


def test_forest_parameters_and_large_tables(rows):
    _, _, df = rows
    base = dict(numTrees=3, maxDepth=4)
    first = [t.packed() for t in Forest(**base).fit(df).trees]
    for change in (dict(maxDepth=2), dict(minInstancesPerNode=40), dict(minSplitRows=200), dict(featureSubsetStrategy="all"), dict(maxBins=3), dict(seed=1)):
        assert [t.packed() for t in Forest(**{**base, **change}).fit(df).trees] != first
    assert type(Forest(**base, oneTableRows=10).fit(df)).__name__ == "RandomForestClassificationModel"
    with pytest.raises(ValueError):
        Forest().fit(df.limit(0))


def test_edges_of_one_task_are_quantiles(spark):
    x = np.round(np.random.default_rng(9).normal(size=(700, 3)), 1)
    x[::50, 1] = math.nan
    t = labelled(table(spark, x, np.zeros(700, int)), "label", "features")
    exact, approximate = bin_edges(t, 3, 16, one_task=True), bin_edges(t, 3, 16)
    for i, (a, b) in enumerate(zip(exact, approximate)):
        column = np.sort(x[~np.isnan(x[:, i]), i])
        assert a == sorted({column[math.ceil(len(column) * k / 16) - 1] for k in range(1, 16)})
        assert len(b) <= 15 and (i == 1 or max(abs(p - q) for p, q in zip(a, b)) < 0.11)
