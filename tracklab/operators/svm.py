"""Linear support vectors with the squared hinge loss, all classes at once (M8).

Every class against the rest minimises ``|w|^2 / 2 + C * sum(max(0, 1 - y w.x)^2)``, the intercept
being the weight of a constant feature.  A Newton step needs, per class, the sums of gradients
and of outer products over the rows inside the margin: one pass over the table gives them for all
classes, tasks hand on one row per class, and Spark adds these up.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRawPredictionCol, HasTol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab.operators.learning import Stored, matrix, with_prediction
from tracklab.sources.staging import stage

# The functions here travel with the tasks that use them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A class' sums have the square of so many numbers at most.
MOST_FEATURES = 2000
# Halvings of a step that does not lower the objective enough, and the share of the promised fall asked for.
HALVINGS, ENOUGH = 30, 1e-4


def _with_constant(column: pa.Array) -> np.ndarray:
    x = matrix(column)
    return np.hstack([x, np.ones((len(x), 1))])


def _sums(weights: np.ndarray, open_classes: list[int]):
    """Task function: (label, x) rows -> per class the losses, gradients and outer products inside the margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = weights.shape[1]
        total = {c: np.zeros(1 + d + d * d) for c in open_classes}
        for batch in batches:
            if not batch.num_rows:
                continue
            label, x = batch.column("label").to_numpy(zero_copy_only=False), _with_constant(batch.column("x"))
            scores = x @ weights.T
            for c in open_classes:
                y = np.where(label == c, 1.0, -1.0)
                slack = 1 - y * scores[:, c]
                inside = slack > 0
                xi, si = x[inside], slack[inside]
                total[c] += np.concatenate([[si @ si], -2 * (xi.T @ (si * y[inside])), 2 * (xi.T @ xi).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(open_classes, pa.int32()), pa.array([total[c] for c in open_classes], pa.list_(pa.float64()))],
                                         ["class", "sums"])

    return run


class SquaredHingeSVC(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasMaxIter, HasTol,
                      DefaultParamsReadable, DefaultParamsWritable):
    """One-vs-rest linear classifier for labels 0, 1, ...; stops when every gradient is below ``tol`` of its first."""

    cost = Param(Params._dummy(), "cost", "weight of the losses", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", rawPredictionCol="rawPrediction",
                 cost=1.0, maxIter=2000, tol=1e-8):
        super().__init__()
        self._setDefault(cost=1.0, maxIter=2000, tol=1e-8)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "SquaredHingeSVCModel":
        cost, tol = self.getOrDefault(self.cost), self.getTol()
        table = stage(dataset.select(F.col(self.getLabelCol()).cast("int").alias("label"),
                                     vector_to_array(self.getFeaturesCol()).alias("x")), "svm-rows")
        size = table.agg(F.max("label").alias("k"), F.max(F.size("x")).alias("d")).first()
        if size["d"] is None:
            raise ValueError("no rows to fit")
        if size["d"] > MOST_FEATURES:
            raise ValueError(f"at most {MOST_FEATURES} features")
        k, d = size["k"] + 1, size["d"] + 1

        def measured(weights: np.ndarray, classes: list[int]) -> dict:
            parts = table.mapInArrow(_sums(weights, classes), "class int, sums array<double>")
            rows = parts.groupBy("class").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect()
            out = {}
            for row in rows:
                c, sums = row["class"], row["sums"].toArray()
                w = weights[c]
                out[c] = (0.5 * w @ w + cost * sums[0], w + cost * sums[1:d + 1], np.eye(d) + cost * sums[d + 1:].reshape(d, d))
            return out

        weights = np.zeros((k, d))
        state = measured(weights, list(range(k)))
        first = {c: np.linalg.norm(state[c][1]) for c in state}
        step = {c: self._newton(state[c]) for c in state}
        size_of = dict.fromkeys(state, 1.0)
        done: set[int] = set()
        for _ in range(self.getMaxIter()):
            active = [c for c in range(k) if c not in done]
            if not active:
                break
            tried = weights.copy()
            for c in active:
                tried[c] += size_of[c] * step[c]
            for c, found in measured(tried, active).items():
                promised = state[c][1] @ step[c] * size_of[c]
                if found[0] > state[c][0] + ENOUGH * promised and size_of[c] > 0.5 ** HALVINGS:
                    size_of[c] /= 2
                    continue
                if found[0] <= state[c][0]:
                    weights[c], state[c] = tried[c], found
                else:  # the objective has no lower value in double arithmetic
                    done.add(c)
                if np.linalg.norm(state[c][1]) <= tol * max(first[c], 1e-300):
                    done.add(c)
                step[c], size_of[c] = self._newton(state[c]), 1.0
        model = SquaredHingeSVCModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
                                     rawPredictionCol=self.getRawPredictionCol())
        model.weights = weights
        return model

    @staticmethod
    def _newton(state: tuple) -> np.ndarray:
        return -np.linalg.solve(state[2], state[1])


class SquaredHingeSVCModel(Stored, Model, HasFeaturesCol, HasPredictionCol, HasRawPredictionCol):
    """The first class with the greatest margin; there are no probabilities."""

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", rawPredictionCol="rawPrediction"):
        super().__init__()
        self._set(**self._input_kwargs)
        self.weights = np.zeros((0, 1))

    @property
    def numClasses(self) -> int:
        return len(self.weights)

    def state(self) -> dict:
        return {"weights": self.weights.tolist()}

    def restore(self, state: dict) -> None:
        self.weights = np.array(state["weights"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = self.weights

        @F.pandas_udf("array<double>")
        def margins(features: pd.Series) -> pd.Series:
            x = np.stack(features.to_list()) if len(features) else np.zeros((0, weights.shape[1] - 1))
            return pd.Series(list(x @ weights[:, :-1].T + weights[:, -1]), dtype=object)

        return with_prediction(dataset, margins(vector_to_array(self.getFeaturesCol())), self.getRawPredictionCol(), self.getPredictionCol())
