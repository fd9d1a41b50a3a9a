"""Gradient-boosted trees of all classes at once (M11): histograms, best-first leaves, leaf penalties.

A round fits one tree per class to the gradients of the softmax loss.  Trees of a round grow
together: one pass over the rows gives, for every leaf that best-first growth may split next in
any class, a histogram of gradients, hessians and rows per feature and bin, and the histogram
gives the leaf's best split.  Leaves are split in order of gain until a tree has ``numLeaves``.

The passes are Spark jobs over a staged table of binned rows: tasks build partial histograms, a
shuffle adds them up, and only the best splits reach the driver.  Up to ``oneTaskRows`` rows, the
size of a search sample, the same growth runs inside one task, where a pass is a function call.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol,
                                     HasSeed, HasStepSize)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklab import schema as S
from tracklab.operators.learning import Stored, Walker, bin_edges, binned, labelled, lists, matrix, uniform, with_prediction
from tracklab.sources.staging import stage

# The functions here travel with the tasks that use them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rounds whose trees are replayed on the staged scores before these are written anew.
REPLAYED = 10
# Least hessian of a leaf, and the least gain of a split.
LEAST_HESSIAN, LEAST_GAIN = 1e-3, 1e-9
# Gains that differ by less, relatively, are equal: sums of one leaf differ by their order.
SAME_GAIN = 1e-9

NODES = "round int, class int, node int, feature int, threshold double, left int, right int, value double, rows double, gain double"
_SPLITS = "class int, node int, total array<double>, gain double, feature int, bin int, low array<double>, high array<double>"


class Settings(NamedTuple):
    rounds: int
    rate: float
    leaves: int
    depth: int          # 0: as deep as the leaves allow
    least_rows: int
    rows_share: float
    columns_share: float
    alpha: float        # absolute penalty of leaf values
    penalty: float      # squared penalty of leaf values
    bins: int
    seed: int
    classes: int
    features: int

    def soft(self, g):
        return np.sign(g) * np.maximum(np.abs(g) - self.alpha, 0.0)

    def value(self, total) -> float:
        """Leaf value of (gradients, hessians, rows)."""
        return float(-self.rate * self.soft(total[0]) / (total[1] + self.penalty + 1e-12))

    def worth(self, g, h):
        return self.soft(g) ** 2 / (h + self.penalty + 1e-12)

    def columns(self, round_: int, c: int) -> np.ndarray:
        """Features that a tree may split."""
        n = max(1, math.ceil(self.columns_share * self.features - 1e-9))
        return np.sort(np.random.default_rng([self.seed, round_, c]).permutation(self.features)[:n])


class Split(NamedTuple):
    gain: float
    feature: int
    bin: int
    low: tuple[float, ...]
    high: tuple[float, ...]


def best_split(histogram: np.ndarray, s: Settings, columns: np.ndarray) -> Split | None:
    """Best cut of a (feature, bin, 3) histogram; the first of equal gains."""
    total = histogram[0].sum(axis=0)
    low = histogram[columns, :-1].cumsum(axis=1)
    high = total - low
    gain = s.worth(low[..., 0], low[..., 1]) + s.worth(high[..., 0], high[..., 1]) - s.worth(total[0], total[1])
    fit = (np.minimum(low[..., 2], high[..., 2]) >= s.least_rows - 0.5) & (np.minimum(low[..., 1], high[..., 1]) >= LEAST_HESSIAN)
    gain = np.where(fit, gain, -np.inf)
    best = gain.max(initial=-np.inf)
    if not best > LEAST_GAIN:
        return None
    i, b = divmod(int((gain >= best * (1 - SAME_GAIN)).argmax()), gain.shape[1])
    return Split(float(gain[i, b]), int(columns[i]), b, tuple(low[i, b].tolist()), tuple(high[i, b].tolist()))


class Tree:
    """A growing tree: nodes with totals, known splits, and children made ahead of the choice."""

    def __init__(self):
        self.total: list = [None]
        self.split: list[Split | None] = [None]
        self.children: list[tuple[int, int] | None] = [None]
        self.depth, self.known = [0], [False]

    def settle(self, node: int, total, split: Split | None) -> None:
        self.total[node], self.split[node], self.known[node] = tuple(total), split, True
        if split:
            self.children[node] = (len(self.total), len(self.total) + 1)
            for part in (split.low, split.high):
                self.total.append(part)
                self.split.append(None)
                self.children.append(None)
                self.depth.append(self.depth[node] + 1)
                self.known.append(False)

    def chosen(self, s: Settings) -> tuple[set[int], list[int]]:
        """Nodes split in order of gain, and their children whose own splits are not known yet."""
        out, missing = set(), []
        queue = [(-self.split[0].gain, 0)] if self.split[0] else []
        while queue and len(out) < s.leaves - 1:
            _, node = heapq.heappop(queue)
            out.add(node)
            for child in self.children[node]:
                if self.known[child]:
                    if self.split[child]:
                        heapq.heappush(queue, (-self.split[child].gain, child))
                elif (s.depth and self.depth[child] >= s.depth) or self.total[child][2] < 2 * s.least_rows - 0.5:
                    self.known[child] = True
                else:
                    missing.append(child)
        return out, missing

    def values(self, s: Settings) -> list[float]:
        """Value of every node: of the leaf that it is, or below which it was made in vain."""
        chosen, _ = self.chosen(s)
        out = [s.value(t) for t in self.total]
        for node, children in enumerate(self.children):
            if children and node not in chosen:
                out[children[0]] = out[children[1]] = out[node]
        return out

    def rows(self, round_: int, c: int, s: Settings, edges: list[list[float]]) -> list[tuple]:
        """Node table of the chosen tree."""
        chosen, _ = self.chosen(s)
        out, queue = [], [0]
        place = {0: 0}
        for node in queue:
            total = self.total[node]
            if node in chosen:
                cut, children = self.split[node], self.children[node]
                for child in children:
                    place[child] = len(queue)
                    queue.append(child)
                out.append((round_, c, place[node], cut.feature, edges[cut.feature][cut.bin], place[children[0]], place[children[1]],
                            0.0, total[2], cut.gain))
            else:
                out.append((round_, c, place[node], -1, math.inf, -1, -1, s.value(total), total[2], 0.0))
        return out


class Rows:
    """Binned rows of a task with their scores, gradients and leaves."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, keys: np.ndarray, scores: np.ndarray, s: Settings):
        self.bins, self.label, self.keys, self.scores, self.s = bins, label, keys, scores, s

    def start(self, round_: int) -> None:
        """Gradients of a round; all rows at the roots.  A row's part in a round follows from its key."""
        e = np.exp(self.scores - self.scores.max(axis=1, keepdims=True)) if len(self.scores) else self.scores
        p = e / e.sum(axis=1, keepdims=True)
        self.g, k = p.copy(), self.s.classes
        self.g[np.arange(len(p)), self.label] -= 1
        self.h = p * (1 - p) * (k / max(k - 1, 1))
        self.used = uniform(self.keys, round_ + 1 + self.s.seed) < self.s.rows_share
        self.at = [{0: np.arange(len(p))} for _ in range(k)]

    def follow(self, c: int, tree: Tree) -> None:
        """Rows of class ``c``'s tree move on to the children that exist by now."""
        at = self.at[c]
        for node, children in enumerate(tree.children):
            if children and node in at:
                rows, cut = at.pop(node), tree.split[node]
                low = self.bins[rows, cut.feature] <= cut.bin
                at[children[0]], at[children[1]] = rows[low], rows[~low]

    def histogram(self, c: int, node: int) -> np.ndarray:
        """(feature, bin, [gradients, hessians, rows]) of one leaf."""
        rows = self.at[c][node]
        rows = rows[self.used[rows]]
        n, width, size = len(rows), self.s.bins, self.s.features * self.s.bins
        cells = (self.bins[rows].astype(np.int32) + np.arange(self.s.features, dtype=np.int32) * width).ravel()
        out = np.empty((size, 3))
        out[:, 0] = np.bincount(cells, np.repeat(self.g[rows, c], self.s.features), size)
        out[:, 1] = np.bincount(cells, np.repeat(self.h[rows, c], self.s.features), size)
        out[:, 2] = np.bincount(cells, minlength=size) if n else 0
        return out.reshape(self.s.features, width, 3)

    def add(self, trees: list[Tree]) -> None:
        """Scores after a round."""
        for c, tree in enumerate(trees):
            self.follow(c, tree)
            values = tree.values(self.s)
            for node, rows in self.at[c].items():
                self.scores[rows, c] += values[node]


Pass = Callable[[list[Tree], list[tuple[int, int]]], dict[tuple[int, int], tuple]]


def grow(s: Settings, run_pass: Pass) -> list[Tree]:
    """Trees of one round; ``run_pass`` gives total and best split of the leaves that it is asked for."""
    trees = [Tree() for _ in range(s.classes)]
    asked = [(c, 0) for c in range(s.classes)]
    while asked:
        for (c, node), (total, split) in sorted(run_pass(trees, asked).items()):
            trees[c].settle(node, total, split)
        asked = [(c, node) for c, tree in enumerate(trees) for node in tree.chosen(s)[1]]
    return trees


def in_task(rows: Rows, s: Settings, round_: int) -> Pass:
    """A pass over rows held by one task.  Of two sister leaves the smaller one is counted and
    the other is its parent's histogram less that."""
    known: dict[tuple[int, int], np.ndarray] = {}

    def run(trees: list[Tree], asked: list[tuple[int, int]]) -> dict:
        for c in {c for c, _ in asked}:
            rows.follow(c, trees[c])
        for c, node in asked:
            if (c, node) in known:
                continue
            family = next(((p, pair) for p, pair in enumerate(trees[c].children) if pair and node in pair), None)
            if family is None:
                known[c, node] = rows.histogram(c, node)
                continue
            parent, pair = family
            small, large = sorted(pair, key=lambda n: trees[c].total[n][2])
            known[c, small] = rows.histogram(c, small)
            known[c, large] = known[c, parent] - known[c, small]
        return {(c, node): (known[c, node][0].sum(axis=0).tolist(), best_split(known[c, node], s, s.columns(round_, c))) for c, node in asked}

    return run


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
    named = [f.rsplit(" ", 1) for f in fields.split(", ")]
    columns = list(zip(*rows)) or [()] * len(named)
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(columns, named)], [n for n, _ in named])


def _whole_fit(s: Settings, edges: list[list[float]], prior: list[float]):
    """Task function: (label, x, key) rows -> node table of all rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        x = np.concatenate([binned(matrix(b.column("x")), edges) for b in table])
        label, keys = (np.concatenate([b.column(n).to_numpy(zero_copy_only=False) for b in table]) for n in ("label", "key"))
        rows = Rows(x, label, keys.view(np.uint64), np.tile(prior, (len(x), 1)), s)
        for round_ in range(s.rounds):
            rows.start(round_)
            trees = grow(s, in_task(rows, s, round_))
            rows.add(trees)
            yield _batch([r for c, t in enumerate(trees) for r in t.rows(round_, c, s, edges)], NODES)

    return run


class _Cluster:
    """Rounds whose passes are Spark jobs over a staged table of (key, label, bins, scores)."""

    def __init__(self, table: DataFrame, s: Settings, edges: list[list[float]], prior: list[float]):
        self.s, self.edges = s, edges

        @F.pandas_udf("binary")
        def bins(x: pd.Series) -> pd.Series:
            return pd.Series([r.tobytes() for r in binned(np.stack(x.to_list()), edges)] if len(x) else [], dtype=object)

        self.table = stage(table.select("key", "label", bins("x").alias("bins"),
                                        F.array(*[F.lit(float(p)) for p in prior]).alias("scores")), "boosting-rows")
        self.recent: list[list[Tree]] = []
        self.first = 0

    def _rows(self, batch: pa.RecordBatch, recent: list[list[Tree]], first: int) -> Rows:
        bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        label, keys = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("label", "key"))
        rows = Rows(bins, label, keys.view(np.uint64), matrix(batch.column("scores")), self.s)
        for i, trees in enumerate(recent):
            rows.start(first + i)
            rows.add(trees)
        return rows

    def passes(self, round_: int) -> Pass:
        s, make = self.s, self._plain()

        def run(trees: list[Tree], asked: list[tuple[int, int]]) -> dict:
            recent, first = self.recent, self.first

            def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sums: dict[tuple[int, int], np.ndarray] = {}
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    rows = make(batch, recent, first)
                    rows.start(round_)
                    for c in {c for c, _ in asked}:
                        rows.follow(c, trees[c])
                    for key in asked:
                        found = rows.histogram(*key)
                        sums[key] = sums[key] + found if key in sums else found
                for (c, node), found in sums.items():
                    yield _batch([(c, node, found.ravel())], "class int, node int, sums array<double>")

            def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                at, total = None, None
                for batch in batches:
                    for i in range(batch.num_rows):
                        key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                        part = batch.column(2)[i].values.to_numpy(zero_copy_only=False).reshape(s.features, s.bins, 3)
                        if key != at and at is not None:
                            yield split_row(at, total)
                        total = part if key != at else total + part
                        at = key
                if at is not None:
                    yield split_row(at, total)

            def split_row(key, total) -> pa.RecordBatch:
                cut = best_split(total, s, s.columns(round_, key[0])) or Split(0.0, -1, -1, (), ())
                return _batch([(*key, total[0].sum(axis=0), *cut)], _SPLITS)

            parts = self.table.mapInArrow(partial, "class int, node int, sums array<double>")
            found = parts.repartition("class", "node").sortWithinPartitions("class", "node").mapInArrow(merged, _SPLITS).collect()
            return {(r["class"], r["node"]): (r["total"], Split(r["gain"], r["feature"], r["bin"], tuple(r["low"]), tuple(r["high"]))
                                              if r["feature"] >= 0 else None) for r in found}

        return run

    def _plain(self):
        """``_rows`` without the staged table, for tasks."""
        other = object.__new__(_Cluster)
        other.s, other.edges = self.s, self.edges
        return other._rows

    def finish_round(self, trees: list[Tree]) -> None:
        self.recent.append(trees)
        if len(self.recent) < REPLAYED:
            return
        recent, first, make = self.recent, self.first, self._plain()

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    scores = make(batch, recent, first).scores
                    yield batch.set_column(3, "scores", pa.ListArray.from_arrays(
                        np.arange(0, scores.size + 1, scores.shape[1], dtype=np.int32), pa.array(scores.ravel())))

        self.table = stage(self.table.mapInArrow(scored, self.table.schema), "boosting-rows")
        self.first, self.recent = self.first + len(recent), []


class _Shared(HasFeaturesCol, HasPredictionCol, HasProbabilityCol):
    pass


class JointBoosting(Estimator, _Shared, HasLabelCol, HasMaxIter, HasStepSize, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees for labels 0, 1, ...; every parameter changes the trees.

    Values are compared in at most ``maxBins`` bins whose edges are approximate quantiles of all rows.
    ``subsamplingRate`` of the rows, by a hash of their values and the round, and ``columnsRate`` of the
    features, by a seed, are used per tree.
    """

    numLeaves = Param(Params._dummy(), "numLeaves", "leaves of a tree", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree, 0 for any", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows per leaf", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "rows per tree", TypeConverters.toFloat)
    columnsRate = Param(Params._dummy(), "columnsRate", "features per tree", TypeConverters.toFloat)
    regAlpha = Param(Params._dummy(), "regAlpha", "absolute penalty of leaf values", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "squared penalty of leaf values", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins per feature", TypeConverters.toInt)
    oneTaskRows = Param(Params._dummy(), "oneTaskRows", "rows up to which one task fits", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                 maxIter=200, stepSize=0.1, numLeaves=31, maxDepth=0, minInstancesPerNode=20, subsamplingRate=1.0,
                 columnsRate=1.0, regAlpha=0.0, regLambda=0.0, maxBins=64, oneTaskRows=200_000, seed=S.SEED):
        super().__init__()
        self._setDefault(maxIter=200, stepSize=0.1, numLeaves=31, maxDepth=0, minInstancesPerNode=20, subsamplingRate=1.0,
                         columnsRate=1.0, regAlpha=0.0, regLambda=0.0, maxBins=64, oneTaskRows=200_000, seed=S.SEED)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "JointBoostingModel":
        get, bins = self.getOrDefault, self.getOrDefault(self.maxBins)
        table = labelled(dataset, self.getLabelCol(), self.getFeaturesCol())
        known = table.groupBy("label").agg(F.count("*").alias("n")).collect()
        counts = {r["label"]: r["n"] for r in known}
        if not counts:
            raise ValueError("no rows to fit")
        width = table.agg(F.max(F.size("x"))).first()[0]
        total = sum(counts.values())
        edges = bin_edges(table, width, bins, one_task=total <= get(self.oneTaskRows))
        s = Settings(self.getMaxIter(), self.getStepSize(), get(self.numLeaves), max(get(self.maxDepth), 0), get(self.minInstancesPerNode),
                     get(self.subsamplingRate), get(self.columnsRate), get(self.regAlpha), get(self.regLambda), bins, self.getSeed(),
                     max(counts) + 1, width)
        prior = [math.log(max(counts.get(c, 0) / total, 1e-15)) for c in range(s.classes)]
        if total <= get(self.oneTaskRows):
            nodes = [tuple(r) for r in table.coalesce(1).mapInArrow(_whole_fit(s, edges, prior), NODES).collect()]
        else:
            cluster, nodes = _Cluster(table, s, edges, prior), []
            for round_ in range(s.rounds):
                trees = grow(s, cluster.passes(round_))
                cluster.finish_round(trees)
                nodes += [r for c, t in enumerate(trees) for r in t.rows(round_, c, s, edges)]
        model = JointBoostingModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
                                   probabilityCol=self.getProbabilityCol())
        model.prior, model.nodes, model.width = prior, nodes, width
        return model


class Forest:
    """The node table as arrays."""

    def __init__(self, nodes: list[tuple], classes: int):
        self.classes = classes
        number = {(r[0], r[1], r[2]): i for i, r in enumerate(nodes)}
        feature = np.array([r[3] for r in nodes], np.int32)
        low, high = (np.array([number[r[0], r[1], r[i]] if r[3] >= 0 else n for n, r in enumerate(nodes)], np.int32) for i in (5, 6))
        roots = [(r[1], i) for i, r in enumerate(nodes) if r[2] == 0]
        walker = Walker(np.array([i for _, i in roots], np.int32), feature, np.array([r[4] for r in nodes]), low, high, feature < 0)
        self.of_class = [c for c, _ in roots]
        self.value = np.array([r[7] for r in nodes])[walker.order]
        walker.order = None  # not needed by tasks
        self.walker = vars(walker)

    def scores(self, x: np.ndarray, prior: list[float]) -> np.ndarray:
        """Sum of the trees' values per row and class."""
        walker = object.__new__(Walker)
        vars(walker).update(self.walker)
        out = np.repeat(np.array(prior, float)[:, None], len(x), axis=1)
        for c, leaf in zip(self.of_class, walker.leaves(x)):
            out[c] += self.value.take(leaf)
        return out.T


class JointBoostingModel(Stored, Model, _Shared):
    """Softmax of the summed trees; the first most probable class is predicted."""

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", probabilityCol="probability"):
        super().__init__()
        self._set(**self._input_kwargs)
        self.prior: list[float] = []
        self.nodes: list[tuple] = []
        self.width = 0

    @property
    def numClasses(self) -> int:
        return len(self.prior)

    def node_table(self, spark) -> DataFrame:
        """Nodes of all trees as rows (``NODES``)."""
        return spark.createDataFrame(pa.Table.from_batches([_batch(self.nodes, NODES)]), schema=T._parse_datatype_string(NODES))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(vars(Forest(self.nodes, self.numClasses)))  # plain arrays: tasks bring the class
        prior = list(self.prior)

        @F.arrow_udf("array<double>")
        def chances(features: pa.Array) -> pa.Array:
            if not len(features):
                return pa.array([], pa.list_(pa.float64()))
            trees = object.__new__(Forest)
            vars(trees).update(shared.value)
            raw = trees.scores(matrix(features), prior)
            e = np.exp(raw - raw.max(axis=1, keepdims=True))
            return lists(e / e.sum(axis=1, keepdims=True))

        return with_prediction(dataset, chances(vector_to_array(self.getFeaturesCol())), self.getProbabilityCol(), self.getPredictionCol())

    def state(self) -> dict:
        return {"prior": self.prior, "width": self.width}

    def restore(self, state: dict) -> None:
        self.prior, self.width = state["prior"], state["width"]

    def save_tables(self, spark: SparkSession, path: str) -> None:
        self.node_table(spark).coalesce(1).write.parquet(f"{path}/nodes")

    def load_tables(self, spark: SparkSession, path: str) -> None:
        self.nodes = [tuple(r) for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "class", "node").collect()]
