"""Random forest (M7): trees are dealt out to tasks over a shared, binned table of bounded size.

Up to ``oneTableRows`` rows, a byte per feature and row, the binned rows are packed, and every
task grows whole trees from its own draws, level by level: one histogram of classes per node, drawn
feature and bin gives all splits of a level.  The table has a row per feature and its cells hold bin and class
together; a tree keeps its rows ordered by node, so a node's histogram is a count over one slice.  A table of up to
``BROADCAST_ROWS`` rows is broadcast; of a larger one every executor keeps a file that its tasks map, so that they share one
copy of it and neither the driver nor a task holds it.  Larger tables are fitted by MLlib's forest, whose
levels are passes over the cluster's rows, with the same parameters.
"""

from __future__ import annotations

import fcntl
import math
import os
import sys
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import suppress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators.learning import Stored, Walker, bin_edges, binned, labelled, lists, matrix, with_prediction
from tracklab.operators.small import literal_table
from tracklab.session import scratch_dir

# The functions here travel with the tasks that use them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells of a level's histogram at a time.
CELLS = 1 << 18
# Rows of a histogram's step, rows from which a node is counted by itself.
PIECE, LARGE = 1 << 18, 1024
# Rows up to which the packed rows are broadcast.
BROADCAST_ROWS = 4_000_000
# Rows up to which one task sorts the values for exact edges.
EXACT_EDGES = 200_000
# MLlib's deepest tree.
DEEPEST = 30


class Growth(NamedTuple):
    classes: int
    bins: int
    depth: int
    leaf: int       # rows of a leaf at least
    split: int      # rows of a node that is split at least
    drawn: int      # features tried per node
    seed: int


class Tree(NamedTuple):
    """Nodes as arrays; a leaf has feature -1 and leads to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray      # node, class -> drawn rows

    def packed(self) -> bytes:
        return b"".join(np.ascontiguousarray(a, t).tobytes() for a, t in zip(self, ("<i4", "<f8", "<i4", "<i4", "<f8")))

    @classmethod
    def unpacked(cls, data: bytes, classes: int) -> "Tree":
        n, at, out = len(data) // (4 + 8 + 4 + 4 + 8 * classes), 0, []
        for kind, width in (("<i4", 1), ("<f8", 1), ("<i4", 1), ("<i4", 1), ("<f8", classes)):
            a = np.frombuffer(data, kind, n * width, at)
            at += a.nbytes
            out.append(a.reshape(n, width) if width == classes and kind == "<f8" and len(out) == 4 else a)
        return cls(*out)


def best_splits(histogram: np.ndarray, g: Growth) -> tuple[np.ndarray, ...]:
    """Per node: drawn feature and bin of the purest halves, and whether there are any (node, drawn, bin, class)."""
    low = histogram.cumsum(axis=2)[:, :, :-1]
    total = histogram[:, :1].sum(axis=2, keepdims=True)
    n_low, n = low.sum(axis=3), total.sum(axis=3)
    n_high = n - n_low
    high = (total - low)
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (low * low).sum(axis=3) / n_low + (high * high).sum(axis=3) / n_high
    purity = np.where((n_low >= g.leaf) & (n_high >= g.leaf), purity, -1.0).reshape(len(histogram), -1)
    at = purity.argmax(axis=1)
    before = ((total * total).sum(axis=3) / np.maximum(n, 1)).reshape(-1)
    fit = purity[np.arange(len(at)), at] > before * (1 + 1e-12)
    return at // low.shape[2], at % low.shape[2], fit


def coded(bins: np.ndarray, label: np.ndarray, g: Growth) -> np.ndarray:
    """Bin and class of every value as one small number, a row per feature: a histogram of it counts both."""
    codes = np.empty(bins.shape[::-1], np.uint8 if g.bins * g.classes <= 256 else np.uint16)
    for f in range(len(codes)):
        codes[f] = bins[:, f].astype(codes.dtype) * g.classes + label.astype(codes.dtype)
    return codes


def grown(bins: np.ndarray, label: np.ndarray, edges: list[list[float]], g: Growth, number: int) -> Tree:
    """Tree ``number`` of rows drawn with repetition; what is drawn follows from seed and number."""
    return grown_of_codes(coded(bins, label, g), edges, g, number)


def _node_histograms(codes: np.ndarray, rows: np.ndarray, first: np.ndarray, size: np.ndarray, drawn: np.ndarray, g: Growth) -> np.ndarray:
    """Rows per (node, drawn feature, bin, class); node k holds ``size[k]`` of ``rows`` from ``first[k]`` on."""
    width = g.bins * g.classes
    out = np.zeros((len(first), g.drawn, width), np.int64)
    large = size >= LARGE
    for k in np.flatnonzero(large):
        for a in range(first[k], first[k] + size[k], PIECE):
            own = rows[a:min(a + PIECE, first[k] + size[k])]
            for j in range(g.drawn):
                out[k, j] += np.bincount(codes[drawn[k, j]].take(own), minlength=width)
    few = np.flatnonzero(~large)
    node, place = members(first[few], size[few])
    flat, base = codes.ravel(), drawn[few] * codes.shape[1]
    sums = np.zeros(len(few) * g.drawn * width, np.int64)
    for a in range(0, len(node), PIECE):
        m, own = node[a:a + PIECE], rows[place[a:a + PIECE]]
        for j in range(g.drawn):
            sums += np.bincount((m * g.drawn + j) * width + flat.take(base[m, j] + own), minlength=len(sums))
    out[few] = sums.reshape(len(few), g.drawn, width)
    return out.reshape(len(first), g.drawn, g.bins, g.classes)


def members(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and place of the members of ranges that start at ``first``."""
    number = np.repeat(np.arange(len(first)), size)
    return number, np.arange(len(number)) + np.repeat(first - (np.cumsum(size) - size), size)


def _part(codes: np.ndarray, rows: np.ndarray, first: np.ndarray, size: np.ndarray, feature: np.ndarray, end: np.ndarray) -> None:
    """Order the rows of every node in place: those with a code below ``end`` of its feature come first."""
    large = size >= LARGE
    for k in np.flatnonzero(large):
        own = rows[first[k]:first[k] + size[k]]
        low = codes[feature[k]].take(own) < end[k]
        own[:] = np.concatenate([own[low], own[~low]])
    few = np.flatnonzero(~large)
    node, place = members(first[few], size[few])
    own = rows[place]
    high = codes.ravel().take(feature[few][node] * codes.shape[1] + own) >= end[few][node]
    rows[place] = own[np.lexsort((high, node))] if len(own) else own


def grown_of_codes(codes: np.ndarray, edges: list[list[float]], g: Growth, number: int) -> Tree:
    """The tree level by level: rows stay ordered by node, so a node's rows are one slice."""
    rng = np.random.default_rng([g.seed, number])
    width, n = codes.shape
    rows = np.sort(rng.integers(0, n, n))
    counts = [np.bincount(codes[0].take(rows) % g.classes, minlength=g.classes).astype(np.float64)]
    feature, threshold, left, right = [-1], [math.inf], [0], [0]
    nodes, first, size, depth = np.array([0]), np.array([0]), np.array([n]), 0
    step = max(1, CELLS // (g.drawn * g.bins * g.classes))
    while len(nodes) and (not g.depth or depth < g.depth):
        known = np.array([counts[k] for k in nodes])
        open_ = (size >= max(g.split, 2 * g.leaf)) & ((known > 0).sum(axis=1) > 1)
        nodes, first, size = nodes[open_], first[open_], size[open_]
        made, starts, sizes = [], [], []
        for i in range(0, len(nodes), step):
            some, at, held = nodes[i:i + step], first[i:i + step], size[i:i + step]
            drawn = rng.random((len(some), width)).argsort(axis=1)[:, :g.drawn]
            histogram = _node_histograms(codes, rows, at, held, drawn, g)
            j, cut, fit = best_splits(histogram.astype(np.float32), g)
            k = np.flatnonzero(fit)
            if not len(k):
                continue
            f, chosen = drawn[k, j[k]], histogram[k, j[k]]
            low = (chosen * (np.arange(g.bins) <= cut[k][:, None])[:, :, None]).sum(axis=1)
            high = chosen.sum(axis=1) - low
            _part(codes, rows, at[k], held[k], f, (cut[k] + 1) * g.classes)
            child = len(feature) + np.arange(2 * len(k))
            for node, split, c, a in zip(some[k].tolist(), f.tolist(), cut[k].tolist(), child[::2].tolist()):
                feature[node], threshold[node], left[node], right[node] = split, edges[split][c], a, a + 1
            feature += [-1] * len(child)
            threshold += [math.inf] * len(child)
            left += child.tolist()
            right += child.tolist()
            counts += list(np.stack([low, high], axis=1).reshape(-1, g.classes).astype(np.float64))
            n_low, n_high = low.sum(axis=1), high.sum(axis=1)
            made.append(child)
            starts.append(np.stack([at[k], at[k] + n_low], axis=1).ravel())
            sizes.append(np.stack([n_low, n_high], axis=1).ravel())
        nodes, first, size = (np.concatenate(a) if a else np.empty(0, np.int64) for a in (made, starts, sizes))
        depth += 1
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(counts))


def mapped(folder: str, name: str, width: int, kind: str) -> np.ndarray:
    """The packed rows of ``folder`` in the order of their keys, from a file of this executor; its first task writes it, column by column."""
    path = os.path.join(tempfile.gettempdir(), name)
    with open(f"{path}.lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(path):
            fs, base = pafs.FileSystem.from_uri(folder)

            def column(c: str, kind: str) -> np.ndarray:
                return np.frombuffer(b"".join(x.as_py() for x in pq.read_table(base, columns=[c], filesystem=fs).column(c)), kind)

            order = np.argsort(column("keys", "<i8"), kind="stable")
            with open(f"{path}.part", "wb") as out:
                for f in range(width):
                    out.write(column(f"f{f}", kind).take(order).data)
            os.replace(f"{path}.part", path)
    return np.asarray(np.memmap(path, kind, "r")).reshape(width, -1)


def unmapped(spark: SparkSession, name: str) -> None:
    """Remove the executors' files of a table; one that gets none of these tasks keeps its file until it ends."""
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in (name, f"{name}.lock"):
                with suppress(FileNotFoundError):
                    os.remove(os.path.join(tempfile.gettempdir(), path))
            yield batch

    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).mapInArrow(remove, "id long").count()


class Forest(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed,
             DefaultParamsReadable, DefaultParamsWritable):
    """A forest for labels 0, 1, ...; classes are the mean of the leaves' shares."""

    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree, 0 for any", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a leaf at least", TypeConverters.toInt)
    minSplitRows = Param(Params._dummy(), "minSplitRows", "rows of a node that is split at least", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "features per split: sqrt, log2 or all", TypeConverters.toString)
    maxBins = Param(Params._dummy(), "maxBins", "bins per feature", TypeConverters.toInt)
    oneTableRows = Param(Params._dummy(), "oneTableRows", "rows up to which they are packed in one table", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", numTrees=100,
                 maxDepth=0, minInstancesPerNode=1, minSplitRows=2, featureSubsetStrategy="sqrt", maxBins=32, oneTableRows=64_000_000, seed=S.SEED):
        super().__init__()
        self._setDefault(numTrees=100, maxDepth=0, minInstancesPerNode=1, minSplitRows=2, featureSubsetStrategy="sqrt", maxBins=32,
                         oneTableRows=64_000_000, seed=S.SEED)
        self._set(**self._input_kwargs)

    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    def getMaxDepth(self) -> int:
        return self.getOrDefault(self.maxDepth)

    def getFeatureSubsetStrategy(self) -> str:
        return self.getOrDefault(self.featureSubsetStrategy)

    def _fit(self, dataset: DataFrame):
        get, spark = self.getOrDefault, dataset.sparkSession
        table = labelled(dataset, self.getLabelCol(), self.getFeaturesCol())
        size = table.agg(F.max("label").alias("k"), F.count("*").alias("n")).first()  # the labels only: no features are made for it
        if not size["n"]:
            raise ValueError("no rows to fit")
        if size["n"] > get(self.oneTableRows):
            return RandomForestClassifier(
                featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol(),
                probabilityCol=self.getProbabilityCol(), numTrees=self.getNumTrees(), maxDepth=min(self.getMaxDepth() or DEEPEST, DEEPEST),
                minInstancesPerNode=max(get(self.minInstancesPerNode), math.ceil(get(self.minSplitRows) / 2)),
                featureSubsetStrategy=self.getFeatureSubsetStrategy(), seed=self.getSeed(), maxMemoryInMB=1024).fit(dataset)
        width = len(table.select("x").first()["x"])
        drawn = {"sqrt": int(math.sqrt(width)), "log2": int(math.log2(width)) if width > 1 else 1, "all": width}[self.getFeatureSubsetStrategy()]
        g = Growth(size["k"] + 1, get(self.maxBins), self.getMaxDepth(), get(self.minInstancesPerNode), get(self.minSplitRows), max(1, drawn),
                   self.getSeed())
        small = size["n"] <= EXACT_EDGES
        # Two passes follow, for edges and bins: the rows are read again, which takes less than to keep all features.
        edges = bin_edges(table, width, get(self.maxBins), one_task=small)
        name, codes = f"forest-{uuid.uuid4().hex}", self._table(table, edges, width, g, size["n"])

        def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number in batch.column(0).to_pylist():
                    tree = zlib.compress(grown_of_codes(codes(name), edges, g, number).packed(), 1)
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([tree], pa.binary())], ["tree", "nodes"])

        tasks = min(self.getNumTrees(), 4 * spark.sparkContext.defaultParallelism)
        try:
            found = spark.range(0, self.getNumTrees(), 1, tasks).mapInArrow(trees, "tree long, nodes binary").collect()
        finally:
            if size["n"] > BROADCAST_ROWS:
                unmapped(spark, name)
        model = ForestModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(), probabilityCol=self.getProbabilityCol(),
                            maxDepth=self.getMaxDepth())
        model.classes, model.trees = g.classes, [Tree.unpacked(zlib.decompress(r["nodes"]), g.classes) for r in sorted(found, key=lambda r: r["tree"])]
        return model

    def _table(self, table: DataFrame, edges: list[list[float]], width: int, g: Growth, rows: int) -> Callable[[str], np.ndarray]:
        """What gives a task the packed rows, by the name of their file."""
        spark = table.sparkSession
        if rows <= BROADCAST_ROWS:
            shared = spark.sparkContext.broadcast(self._codes(table, edges, width, g))
            return lambda name: shared.value
        columns = [f"f{i}" for i in range(width)]

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    codes = coded(binned(matrix(batch.column(2)), edges), batch.column(0).to_numpy(), g)
                    block = [batch.column(1).to_numpy().astype("<i8").tobytes(), *(c.tobytes() for c in codes)]
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary()) for part in block], ["keys", *columns])

        folder, kind = scratch_dir(spark, "forest-codes"), "<u1" if g.bins * g.classes <= 256 else "<u2"
        table.select("label", "key", "x").mapInArrow(packed, ", ".join(f"{c} binary" for c in ("keys", *columns))).write.parquet(folder)
        return lambda name: mapped(folder, name, width, kind)

    def _codes(self, table: DataFrame, edges: list[list[float]], width: int, g: Growth) -> np.ndarray:
        """Binned rows in the order of their keys; the order is made here, of the keys alone, so no row is shuffled."""
        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    block = (binned(matrix(batch.column(2)), edges).tobytes(), batch.column(0).to_numpy().astype("<i4").tobytes(),
                             batch.column(1).to_numpy().astype("<i8").tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary()) for part in block], ["bins", "labels", "keys"])

        blocks = table.select("label", "key", "x").mapInArrow(packed, "bins binary, labels binary, keys binary").collect()
        bins, label, key = (np.frombuffer(b"".join(r[c] for r in blocks), t) for c, t in (("bins", np.uint8), ("labels", "<i4"), ("keys", "<i8")))
        order = np.lexsort((label, key))
        return coded(bins.reshape(-1, width)[order], label[order], g)


class Scorer:
    """All trees in a row, with shares of classes in place of counts; leaves of one class share a row of ``shares``."""

    def __init__(self, trees: list[Tree]):
        sizes = np.array([len(t.feature) for t in trees])
        first = np.cumsum(sizes) - sizes
        feature = np.concatenate([t.feature for t in trees])
        low, high = (np.concatenate([t[i] + a for t, a in zip(trees, first)]) for i in (2, 3))
        walker = Walker(first, feature, np.concatenate([t.threshold for t in trees]), low, high, feature < 0)
        counts = np.concatenate([t.counts for t in trees])[walker.order]
        mixed = ((counts > 0).sum(axis=1) > 1) & (feature[walker.order] < 0)
        self.share = np.where(mixed, counts.shape[1] + np.cumsum(mixed) - 1, counts.argmax(axis=1)).astype(np.int32)
        self.shares = np.concatenate([np.eye(counts.shape[1]), counts[mixed] / counts[mixed].sum(axis=1, keepdims=True)])
        walker.order = None  # not needed by tasks
        self.walker = vars(walker)

    def chances(self, x: np.ndarray) -> np.ndarray:
        walker = object.__new__(Walker)
        vars(walker).update(self.walker)
        out = np.zeros((len(x), self.shares.shape[1]))
        for leaf in walker.leaves(x):
            out += self.shares.take(self.share.take(leaf), axis=0)
        return out / walker.trees


class ForestModel(Stored, Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol):
    """Mean of the trees' class shares; the first most probable class is predicted."""

    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree, 0 for any", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", probabilityCol="probability", maxDepth=0):
        super().__init__()
        self._set(**self._input_kwargs)
        self.classes, self.trees = 0, []

    @property
    def numClasses(self) -> int:
        return self.classes

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def node_table(self, spark) -> DataFrame:
        """(tree, node, feature, threshold, left, right, rows) of all nodes; feature -1 in leaves."""
        schema, classes = "tree int, node int, feature int, threshold double, left int, right int, rows double", self.classes

        def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, zipped in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    t = Tree.unpacked(zlib.decompress(zipped), classes)
                    n = len(t.feature)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, i, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(t.feature), pa.array(t.threshold),
                         pa.array(t.left), pa.array(t.right), pa.array(t.counts.sum(axis=1))],
                        ["tree", "node", "feature", "threshold", "left", "right", "rows"])

        return self._stored(spark).mapInArrow(nodes, schema)

    def _stored(self, spark: SparkSession) -> DataFrame:
        return literal_table(spark, [(i, zlib.compress(t.packed(), 1)) for i, t in enumerate(self.trees)], "tree int, zipped binary")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(vars(Scorer(self.trees)))  # plain arrays: tasks bring the class

        @F.arrow_udf("array<double>")
        def chances(features: pa.Array) -> pa.Array:
            if not len(features):
                return pa.array([], pa.list_(pa.float64()))
            scorer = object.__new__(Scorer)
            vars(scorer).update(shared.value)
            return lists(scorer.chances(matrix(features)))

        return with_prediction(dataset, chances(vector_to_array(self.getFeaturesCol())), self.getProbabilityCol(), self.getPredictionCol())

    def state(self) -> dict:
        return {"classes": self.classes}

    def restore(self, state: dict) -> None:
        self.classes = state["classes"]

    def save_tables(self, spark: SparkSession, path: str) -> None:
        self._stored(spark).coalesce(1).write.parquet(f"{path}/trees")

    def load_tables(self, spark: SparkSession, path: str) -> None:
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        self.trees = [Tree.unpacked(zlib.decompress(r["zipped"]) if "zipped" in r else bytes(r["nodes"]), self.classes) for r in rows]
