"""Pipeline stages: feature engineering, outlier fences and the population-std scaler."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.functions.features import engineered, feature_names
from tracklab.operators.cleaning import add_missing_features, cast_bool, clipped, fit_fences
from tracklab.operators.small import column_ranges, column_sums

FEATURES_COL = "features"
SCALED_PREFIX = "z_"


class InputGuard(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Model inputs made complete: absent ones appended as 0, booleans cast."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return cast_bool(add_missing_features(dataset))


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Casts the 15 inputs to double and appends the 27 derived features."""

    def getOutputCols(self) -> list[str]:
        return feature_names()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {c: F.col(c).cast("double") for c in S.FEATURES} | engineered()
        )


class OutlierFence(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the IQR fences of the clip columns."""

    def _fit(self, dataset: DataFrame) -> "OutlierFenceModel":
        limits = fit_fences(dataset)
        return OutlierFenceModel(
            columns=list(limits), lower=[lo for lo, _ in limits.values()],
            upper=[hi for _, hi in limits.values()],
        )


class OutlierFenceModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    columns = Param(Params._dummy(), "columns", "clipped columns", TypeConverters.toListString)
    lower = Param(Params._dummy(), "lower", "lower fences", TypeConverters.toListFloat)
    upper = Param(Params._dummy(), "upper", "upper fences", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns=None, lower=None, upper=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def limits(self) -> dict[str, tuple[float, float]]:
        get = self.getOrDefault
        return dict(zip(get(self.columns), zip(get(self.lower), get(self.upper))))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {c: clipped(F.col(c), lo, hi) for c, (lo, hi) in self.limits().items()}
        )


class PopStdScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Zero mean, unit population std; a constant column is only centred.

    Works on named columns, so scaling stays inside generated code and the numbers
    can be read column by column.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopStdScalerModel":
        columns = self.getInputCols()
        first = column_ranges(dataset, columns)
        means = {c: first[c][1] or 0.0 for c in columns}
        squares = column_sums(dataset, {c: (F.col(c) - means[c]) * (F.col(c) - means[c]) for c in columns})

        def scale(c: str) -> float:
            n, _, low, high = first[c]
            return (squares[c] / n) ** 0.5 if n and low < high else 1.0

        return PopStdScalerModel(
            inputCols=columns, outputCols=self.getOutputCols(),
            means=[means[c] for c in columns], stds=[scale(c) for c in columns])


class PopStdScalerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "column scales", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return dataset.withColumns({
            out: (F.col(c) - F.lit(m)) / F.lit(s)
            for c, out, m, s in zip(self.getInputCols(), self.getOutputCols(), get(self.means), get(self.stds))
        })


def scaled_names() -> list[str]:
    return [SCALED_PREFIX + c for c in feature_names()]


def preprocessor(clip: bool = False) -> Pipeline:
    """Engineer, scale, assemble.  ``clip`` also fences the inputs, in fitting and scoring alike."""
    stages = [InputGuard()]
    if clip:
        stages.append(OutlierFence())
    stages += [
        FeatureEngineer(),
        PopStdScaler(inputCols=feature_names(), outputCols=scaled_names()),
        VectorAssembler(inputCols=scaled_names(), outputCol=FEATURES_COL, handleInvalid="keep"),
    ]
    return Pipeline(stages=stages)
