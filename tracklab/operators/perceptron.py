"""Multilayer perceptron with early stopping (M10): ReLU layers, adaptive steps, weight penalty.

An epoch visits the rows in batches chosen by a hash of row and epoch; a batch's gradient moves the
weights by adaptive moments.  A tenth of the rows, chosen by a hash, is held out, and training
stops when its accuracy has not risen for some epochs; the best weights are kept.

A step needs one vector, the sum of the batch's gradients.  Over a staged table it is the sum of
task vectors, a Spark job; up to ``oneTaskRows`` rows, the size of a search sample, the same steps run
inside one task, where the sum is a function call.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol,
                                     HasSeed, HasStepSize, HasTol)
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators.learning import Stored, labelled, matrix, uniform, with_prediction
from tracklab.sources.staging import stage

# The functions here travel with the tasks that use them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Moment decays and the guard of the adaptive steps.
DECAY, SQUARE_DECAY, GUARD = 0.9, 0.999, 1e-8
# Rows of a batch at least, and steps of an epoch at most over a staged table: batches grow with the rows.
BATCH, MOST_STEPS = 200, 20


class Net(NamedTuple):
    """Layer sizes; all weights are one vector, per layer a matrix and its constants."""

    layers: tuple[int, ...]

    @property
    def size(self) -> int:
        return sum((a + 1) * b for a, b in zip(self.layers, self.layers[1:]))

    def first(self, seed: int) -> np.ndarray:
        """Uniform weights, wide as their layer's inputs and outputs ask for."""
        rng, out = np.random.default_rng(seed), []
        for a, b in zip(self.layers, self.layers[1:]):
            bound = np.sqrt(6 / (a + b))
            out += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
        return np.concatenate(out)

    def parts(self, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at = 0
        for a, b in zip(self.layers, self.layers[1:]):
            yield weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + (a + 1) * b]
            at += (a + 1) * b

    def chances(self, weights: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self._forward(weights, x)[-1]

    def _forward(self, weights: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        values = [x]
        for i, (w, b) in enumerate(self.parts(weights), 2):
            z = values[-1] @ w + b
            values.append(np.maximum(z, 0) if i < len(self.layers) else z)
        e = np.exp(values[-1] - values[-1].max(axis=1, keepdims=True))
        values[-1] = e / e.sum(axis=1, keepdims=True)
        return values

    def gradient(self, weights: np.ndarray, x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
        """Sums over the rows of the gradient and of the cross-entropy."""
        values = self._forward(weights, x)
        at = np.arange(len(x))
        loss = float(-np.log(np.maximum(values[-1][at, label], 1e-300)).sum())
        delta = values[-1].copy()
        delta[at, label] -= 1
        out = []
        for i, (w, _) in reversed(list(enumerate(self.parts(weights)))):
            out.append(np.concatenate([(values[i].T @ delta).ravel(), delta.sum(axis=0)]))
            if i:
                delta = (delta @ w.T) * (values[i] > 0)
        return np.concatenate(out[::-1]), loss

    def penalised(self, weights: np.ndarray) -> np.ndarray:
        """The weights with zeros for the constants, which are free."""
        return np.concatenate([v for w, b in self.parts(weights) for v in (w.ravel(), np.zeros(len(b)))])


class Plan(NamedTuple):
    net: Net
    rate: float
    penalty: float
    epochs: int
    tol: float
    patience: int
    held_out: float
    seed: int
    steps: int      # batches of an epoch

    def is_held_out(self, keys: np.ndarray) -> np.ndarray:
        return uniform(keys, self.seed) < self.held_out

    def batch(self, keys: np.ndarray, epoch: int) -> np.ndarray:
        """Number of the batch of every row."""
        return (uniform(keys, self.seed + 1 + epoch) * self.steps).astype(np.int64)


Gradient = Callable[[np.ndarray, int, int], tuple[np.ndarray, float, int]]


def trained(plan: Plan, gradient: Gradient, accuracy: Callable[[np.ndarray], float | None]) -> tuple[np.ndarray, list[float]]:
    """Best weights and the held-out accuracy after every epoch (the falling loss where nothing is held out)."""
    weights = plan.net.first(plan.seed)
    mean, square, t = np.zeros_like(weights), np.zeros_like(weights), 0
    best, kept, waited, course = -np.inf, weights, 0, []
    for epoch in range(plan.epochs):
        losses = rows = 0
        for step in range(plan.steps):
            g, loss, n = gradient(weights, epoch, step)
            if not n:
                continue
            g = (g + plan.penalty * plan.net.penalised(weights)) / n
            t, losses, rows = t + 1, losses + loss, rows + n
            mean = DECAY * mean + (1 - DECAY) * g
            square = SQUARE_DECAY * square + (1 - SQUARE_DECAY) * g * g
            weights = weights - plan.rate * np.sqrt(1 - SQUARE_DECAY ** t) / (1 - DECAY ** t) * mean / (np.sqrt(square) + GUARD)
        score = accuracy(weights)
        score = -losses / max(rows, 1) if score is None else score
        course.append(score)
        waited = 0 if score > best + plan.tol else waited + 1
        if score > best:
            best, kept = score, weights
        if waited > plan.patience:
            break
    return kept, course


class _Held:
    """Rows held by one task."""

    def __init__(self, plan: Plan, label: np.ndarray, x: np.ndarray, keys: np.ndarray):
        order = np.argsort(keys, kind="stable")
        label, x, keys = label[order], x[order], keys[order]
        out = plan.is_held_out(keys)
        self.plan, self.out, self.kept = plan, (label[out], x[out]), (label[~out], x[~out], keys[~out])
        self.epoch, self.order, self.ends = -1, None, None

    def gradient(self, weights: np.ndarray, epoch: int, step: int) -> tuple[np.ndarray, float, int]:
        label, x, keys = self.kept
        if epoch != self.epoch:
            batch = self.plan.batch(keys, epoch)
            self.epoch, self.order = epoch, np.argsort(batch, kind="stable")
            self.ends = np.searchsorted(batch[self.order], np.arange(self.plan.steps + 1))
        rows = self.order[self.ends[step]:self.ends[step + 1]]
        return (*self.plan.net.gradient(weights, x[rows], label[rows]), len(rows)) if len(rows) else (0, 0.0, 0)

    def accuracy(self, weights: np.ndarray) -> float | None:
        label, x = self.out
        return float((self.plan.net.chances(weights, x).argmax(axis=1) == label).mean()) if len(label) else None


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    label, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "key"))
    return label.astype(np.int64), matrix(batch.column("x")), keys.view(np.uint64)


def _whole_fit(plan: Plan):
    """Task function: all rows -> one row of weights and course."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_arrays(b) for b in batches if b.num_rows]
        if parts:
            held = _Held(plan, *(np.concatenate(p) for p in zip(*parts)))
            found = trained(plan, held.gradient, held.accuracy)
            yield pa.RecordBatch.from_arrays([pa.array([list(v)], pa.list_(pa.float64())) for v in found], ["weights", "course"])

    return run


class _Cluster:
    """Steps and accuracies as Spark jobs over a staged table."""

    def __init__(self, plan: Plan, table: DataFrame):
        self.plan, self.table = plan, stage(table, "perceptron-rows")

    def _sum(self, task) -> np.ndarray:
        """Sum of the one vector that every task gives."""
        parts = self.table.mapInArrow(task, "sums array<double>")
        return parts.agg(Summarizer.sum(array_to_vector("sums"))).first()[0].toArray()

    def gradient(self, weights: np.ndarray, epoch: int, step: int) -> tuple[np.ndarray, float, int]:
        plan = self.plan

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(weights) + 2)
            for batch in batches:
                label, x, keys = _arrays(batch)
                use = (plan.batch(keys, epoch) == step) & ~plan.is_held_out(keys)
                if use.any():
                    g, loss = plan.net.gradient(weights, x[use], label[use])
                    total += np.concatenate([g, [loss, use.sum()]])
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

        total = self._sum(task)
        return total[:-2], float(total[-2]), int(total[-1])

    def accuracy(self, weights: np.ndarray) -> float | None:
        plan = self.plan

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            right = n = 0
            for batch in batches:
                label, x, keys = _arrays(batch)
                out = plan.is_held_out(keys)
                if out.any():
                    right += int((plan.net.chances(weights, x[out]).argmax(axis=1) == label[out]).sum())
                    n += int(out.sum())
            yield pa.RecordBatch.from_arrays([pa.array([[float(right), float(n)]], pa.list_(pa.float64()))], ["sums"])

        right, n = self._sum(task)
        return right / n if n else None


class Perceptron(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasMaxIter, HasStepSize, HasSeed,
                 HasTol, DefaultParamsReadable, DefaultParamsWritable):
    """Hidden layers of the given sizes for labels 0, 1, ...; ``maxIter`` counts epochs."""

    hidden = Param(Params._dummy(), "hidden", "sizes of the hidden layers", TypeConverters.toListInt)
    penalty = Param(Params._dummy(), "penalty", "squared penalty of the weights, per batch", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "epochs without a rise before it stops", TypeConverters.toInt)
    heldOut = Param(Params._dummy(), "heldOut", "share of rows that decide when to stop", TypeConverters.toFloat)
    oneTaskRows = Param(Params._dummy(), "oneTaskRows", "rows up to which one task fits", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                 hidden=[128, 64], maxIter=200, stepSize=1e-3, penalty=1e-4, tol=1e-4, patience=10, heldOut=0.1,
                 oneTaskRows=200_000, seed=S.SEED):
        super().__init__()
        self._setDefault(hidden=[128, 64], maxIter=200, stepSize=1e-3, penalty=1e-4, tol=1e-4, patience=10, heldOut=0.1,
                         oneTaskRows=200_000, seed=S.SEED)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PerceptronModel":
        get = self.getOrDefault
        table = labelled(dataset, self.getLabelCol(), self.getFeaturesCol())
        size = table.agg(F.max("label").alias("k"), F.max(F.size("x")).alias("d"), F.count("*").alias("n")).first()
        if not size["n"]:
            raise ValueError("no rows to fit")
        one_task = size["n"] <= get(self.oneTaskRows)
        steps = max(1, round(size["n"] * (1 - get(self.heldOut)) / BATCH))
        plan = Plan(Net((size["d"], *get(self.hidden), size["k"] + 1)), self.getStepSize(), get(self.penalty), self.getMaxIter(), self.getTol(),
                    get(self.patience), get(self.heldOut), self.getSeed(), steps if one_task else min(steps, MOST_STEPS))
        if one_task:
            row = table.coalesce(1).mapInArrow(_whole_fit(plan), "weights array<double>, course array<double>").first()
            weights, course = np.array(row["weights"]), row["course"]
        else:
            cluster = _Cluster(plan, table)
            weights, course = trained(plan, cluster.gradient, cluster.accuracy)
        model = PerceptronModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
                                probabilityCol=self.getProbabilityCol())
        model.restore({"layers": plan.net.layers, "weights": weights, "course": course})
        return model


class PerceptronModel(Stored, Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol):
    """Class probabilities; the first most probable class is predicted.  ``course``: accuracy by epoch."""

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", probabilityCol="probability"):
        super().__init__()
        self._set(**self._input_kwargs)
        self.restore({"layers": (1, 1), "weights": [0.0, 0.0], "course": []})

    def state(self) -> dict:
        return {"layers": list(self.net.layers), "weights": self.weights.tolist(), "course": list(self.course)}

    def restore(self, state: dict) -> None:
        self.net, self.weights, self.course = Net(tuple(state["layers"])), np.array(state["weights"]), list(state["course"])

    @property
    def numClasses(self) -> int:
        return self.net.layers[-1]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast((self.net.layers, self.weights))

        @F.pandas_udf("array<double>")
        def chances(features: pd.Series) -> pd.Series:
            layers, weights = shared.value
            return pd.Series(list(Net(layers).chances(weights, np.stack(features.to_list()))) if len(features) else [], dtype=object)

        return with_prediction(dataset, chances(vector_to_array(self.getFeaturesCol())), self.getProbabilityCol(), self.getPredictionCol())
