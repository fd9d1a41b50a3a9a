"""Pieces shared by the library's own learners: row hashes, feature matrices, stored state."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The functions here travel with the tasks that use them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Values that stand for the rows of a feature in one sketch, and rows of a sketch.
SKETCH_POINTS, SKETCH_ROWS = 10_000, 250_000
# Levels that rows walk down a tree between two looks for those at a leaf.
LEVELS = 4
# A node's number: places of its threshold (lowest), feature and lower child.
PLACE_BITS, FEATURE_BITS = 20, 16


def uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number from [0, 1) per row key (uint64) and salt, the same wherever it is computed."""
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * salt) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(33)).astype(np.float64) / (1 << 31)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def labelled(dataset: DataFrame, label: str, features: str) -> DataFrame:
    """(label int, x array, key long) of the rows to fit; the key is a hash of the row's values."""
    rows = dataset.select(F.col(label).cast("int").alias("label"), vector_to_array(features).alias("x"))
    return rows.withColumn("key", F.xxhash64("label", "x"))


def bin_edges(table: DataFrame, width: int, bins: int, one_task: bool = False) -> list[list[float]]:
    """Upper edges of at most ``bins`` bins per feature: quantiles of all rows.

    Exact ones by one task for a table that fits one, or approximate ones: tasks sketch their rows by sorted
    values at even ranks, and a feature's sketches, each value with the rows it stands for, meet in a group.
    A rank is off by at most a share of 1 / ``SKETCH_POINTS``.
    """
    if not 2 <= bins <= 256:
        raise ValueError("there are 2 to 256 bins")
    steps = [i / bins for i in range(1, bins)]

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [matrix(b.column(0)) for b in batches if b.num_rows]
        x = np.sort(np.concatenate(parts), axis=0) if parts else np.empty((0, width))
        for i in range(width if len(x) else 0):
            column = x[~np.isnan(x[:, i]), i]
            at = np.maximum(np.ceil(np.array(steps) * len(column)).astype(int) - 1, 0)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([column[at] if len(column) else []], pa.list_(pa.float64()))], ["i", "x"])

    def sketch(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x = np.concatenate(parts)
        for i in range(width):
            column = np.sort(x[~np.isnan(x[:, i]), i])
            n, m = len(column), min(len(column), SKETCH_POINTS)
            at = np.arange(1, m + 1) * n // max(m, 1) - 1
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([column[at]], pa.list_(pa.float64())), pa.array([n], pa.int64())],
                                             ["i", "x", "n"])

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(matrix(batch.column(0)))
                n += batch.num_rows
            if n >= SKETCH_ROWS:
                yield from sketch(parts)
                parts, n = [], 0
        if n:
            yield from sketch(parts)

    def cuts(group: pa.Table) -> pa.Table:
        found = [(np.array(x, np.float64), n) for x, n in zip(group["x"].to_pylist(), group["n"].to_pylist()) if n]
        if not found:
            return group.select(["i", "x"]).slice(0, 0)
        x = np.concatenate([v for v, _ in found])
        # Rows up to every value; those of one sketch are whole numbers that sum to its rows.
        rows = np.concatenate([np.diff(np.arange(len(v) + 1) * n // len(v)) for v, n in found])
        order = np.argsort(x, kind="stable")
        upto = np.cumsum(rows[order])
        wanted = np.maximum(np.ceil(np.array(steps) * upto[-1]), 1)
        return pa.table([group["i"].slice(0, 1), pa.array([x[order][np.searchsorted(upto, wanted)]], pa.list_(pa.float64()))], ["i", "x"])

    if one_task:
        made = table.select("x").coalesce(1).mapInArrow(exact, "i int, x array<double>").collect()
    else:
        made = table.select("x").mapInArrow(sketches, "i int, x array<double>, n long").groupBy("i").applyInArrow(cuts, "i int, x array<double>").collect()
    found = {r["i"]: r["x"] for r in made}
    return [sorted(set(found.get(i, ()))) for i in range(width)]


def binned(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin of every value: the first whose edge is not below it; a missing value is in the last."""
    return np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1).astype(np.uint8)


class Walker:
    """Trees for scoring, as plain arrays: a value becomes its place among the feature's thresholds, and a node is one
    number that holds its threshold's place, its feature and its lower child.

    Nodes are numbered anew, tree by tree and level by level, so that the upper child follows the lower one; leaves lead to themselves.
    ``order`` gives the old numbers.
    """

    def __init__(self, root: np.ndarray, feature: np.ndarray, threshold: np.ndarray, low: np.ndarray, high: np.ndarray, leaf: np.ndarray):
        levels, trees, lower, seen = [np.asarray(root, np.int64)], [np.arange(len(root))], [], len(root)
        while len(levels[-1]):
            own = levels[-1]
            inner = ~leaf[own]
            place = np.arange(seen - len(own), seen)
            lower.append(np.where(inner, seen + 2 * (np.cumsum(inner) - 1), place))
            levels.append(np.stack([low[own[inner]], high[own[inner]]], axis=1).ravel().astype(np.int64))
            trees.append(np.repeat(trees[-1][inner], 2))
            seen += len(levels[-1])
        by = np.argsort(np.concatenate(trees), kind="stable")  # a tree's nodes side by side
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        self.order, inner = np.concatenate(levels)[by], ~leaf
        self.trees, self.roots = len(root), place[:len(root)]
        cut = np.full(len(feature), (1 << PLACE_BITS) - 1, np.int64)
        self.edges = []
        for f in range(int(feature[inner].max(initial=-1)) + 1):
            own = np.flatnonzero(inner & (feature == f))
            self.edges.append(np.unique(threshold[own]))
            cut[own] = np.searchsorted(self.edges[-1], threshold[own])
        if max(map(len, self.edges), default=0) >= (1 << PLACE_BITS) - 1 or len(self.edges) > 1 << FEATURE_BITS:
            raise ValueError("too many thresholds or features")
        packed = np.where(inner, feature, 0).astype(np.int64) << PLACE_BITS | cut
        self.nodes = place[np.concatenate(lower or [np.empty(0, np.int64)])[by]] << PLACE_BITS + FEATURE_BITS | packed[self.order]

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Per tree the leaf of every row; a missing value goes to the upper child."""
        most = max(map(len, self.edges), default=0)
        cells = np.concatenate([np.searchsorted(e, x[:, f]).astype(np.min_scalar_type(most)) for f, e in enumerate(self.edges)] or [np.zeros(len(x), np.uint8)])
        n, end = len(x), (1 << PLACE_BITS) - 1
        every = np.arange(n)
        for root in self.roots:
            at, way, node = np.empty(n, np.int64), every, np.full(n, root)
            while len(way):
                for _ in range(LEVELS):
                    held = self.nodes.take(node)
                    node = (held >> PLACE_BITS + FEATURE_BITS) + (cells.take((held >> PLACE_BITS & (1 << FEATURE_BITS) - 1) * n + way) > (held & end))
                at[way] = node
                go = np.flatnonzero((self.nodes.take(node) & end) != end)
                way, node = way.take(go), node.take(go)
            yield at


def lists(rows: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


def with_prediction(dataset: DataFrame, scores, vector: str, prediction: str) -> DataFrame:
    """``scores``, an array column, as vector ``vector``, and its first greatest place as ``prediction``."""
    name = "_scores"
    while name in dataset.columns:
        name += "_"
    return (dataset.withColumn(name, scores).withColumn(prediction, (F.array_position(name, F.array_max(name)) - 1).cast("double"))
            .withColumn(vector, array_to_vector(F.col(name))).drop(name))


class StoredWriter(MLWriter):
    """Parameters and state as metadata; ``save_tables`` of the model writes what is a table."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc, extraMetadata=self.instance.state())
        self.instance.save_tables(self.sparkSession, path)


class StoredReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.restore(metadata)
        model.load_tables(self.sparkSession, path)
        return model


class Stored(MLWritable, MLReadable):
    """A model whose ``state()``, plain values, is kept with its parameters; ``restore`` takes it back."""

    def write(self) -> MLWriter:
        return StoredWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return StoredReader(cls)

    def save_tables(self, spark: SparkSession, path: str) -> None:
        pass

    def load_tables(self, spark: SparkSession, path: str) -> None:
        pass
