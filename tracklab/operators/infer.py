"""Scoring with a fitted pipeline: labels, probabilities, batch output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab.functions.features import percent
from tracklab.operators.cleaning import add_missing_features, drop_identifiers
from tracklab.operators.recommend import top_classes


def bundle(preprocessor: PipelineModel, model, decoder: IndexToString) -> PipelineModel:
    """Preprocessing, classifier and label decoding as one persistable pipeline."""
    return PipelineModel(stages=[*preprocessor.stages, model, decoder])


def classes_of(pipeline: PipelineModel) -> list[str]:
    return pipeline.stages[-1].getLabels()


def predict(df: DataFrame, pipeline: PipelineModel, keep: Sequence[str] = (), decode: bool = True) -> DataFrame:
    """``keep`` columns and the predicted label, or its code when not decoded."""
    scored = pipeline.transform(df)
    return scored.select(*keep, "predicted_genre" if decode else F.col("prediction").cast("int"))


def predict_proba(df: DataFrame, pipeline: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and one probability column per class; an error without probabilities."""
    scored = pipeline.transform(df)
    if "probability" not in scored.columns:
        raise AttributeError("the model gives no probabilities")
    return cells(scored, "probability", keep, classes_of(pipeline))


def cells(df: DataFrame, vector: str, keep: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``keep`` columns and the cells of a vector by name; the vector is unpacked once per row, not once per cell."""
    array = "_cells"
    while array in keep:
        array += "_"
    unpacked = df.select(*keep, vector_to_array(vector).alias(array))
    return unpacked.select(*keep, *[F.get(array, F.lit(i)).alias(c) for i, c in enumerate(names)])


def ranked_classes(df: DataFrame, pipeline: PipelineModel, keep: Sequence[str], k: int | None = None) -> DataFrame:
    """(keep..., rank, class, probability), all classes or the k best per row."""
    classes = classes_of(pipeline)
    return top_classes(predict_proba(df, pipeline, keep), {c: c for c in classes}, keep, k or len(classes))


def score_batch(df: DataFrame, pipeline: PipelineModel) -> DataFrame:
    """Input columns, filled model inputs, ``predicted_genre`` and ``confidence`` in percent.

    Map-only and without a row cap; the classifier is evaluated once per row.
    """
    filled = add_missing_features(df)
    scored = pipeline.transform(filled.withColumns({f"_in_{c}": F.col(c) for c in filled.columns}))
    out = [F.col(f"_in_{c}").alias(c) for c in filled.columns] + [F.col("predicted_genre")]
    if "probability" in scored.columns:
        out.append(percent(F.array_max(vector_to_array("probability"))).alias("confidence"))
    return scored.select(*out)


def preprocess(df: DataFrame, preprocessor: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """Scaled model inputs of raw rows; inputs are not clipped unless the pipeline was built to."""
    kept = df.withColumns({f"_in_{c}": F.col(c) for c in keep})
    return preprocessor.transform(drop_identifiers(kept)).select(
        *[F.col(f"_in_{c}").alias(c) for c in keep], "features")
