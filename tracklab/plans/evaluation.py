"""The evaluation run: score the test rows, then all metric tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab.operators import metrics as E
from tracklab.operators.infer import classes_of
from tracklab.sources.files import write_improvement_log, write_report
from tracklab.sources.staging import stage


def scored_rows(rows: DataFrame, pipeline: PipelineModel, target: str) -> DataFrame:
    """y_true, y_pred and one p_<i> column per class, staged for the metric jobs."""
    scored = pipeline.transform(rows)
    p = []
    if "probability" in scored.columns:
        array = vector_to_array("probability")
        p = [F.get(array, F.lit(i)).alias(f"p_{i}") for i in range(len(classes_of(pipeline)))]
    return stage(scored.select(
        F.col(target).alias("y_true"), F.col("predicted_genre").alias("y_pred"), *p), "scored-rows")


def _probabilities(pipeline: PipelineModel) -> dict[str, str]:
    return {c: f"p_{i}" for i, c in enumerate(classes_of(pipeline))}


def metrics(scored: DataFrame, pipeline: PipelineModel) -> DataFrame:
    """The one-row evaluation summary of scored rows; no area without probabilities."""
    matrix = E.confusion(scored)
    if "p_0" not in scored.columns:
        return E.metric_row(matrix).withColumn("macro_auc", F.lit(None).cast("double"))
    return E.metrics_with_auc(matrix, E.auc_per_class(scored, _probabilities(pipeline)), classes_of(pipeline))


def evaluate(rows: DataFrame, pipeline: PipelineModel, target: str, out: str | None = None) -> dict[str, DataFrame]:
    """All evaluation tables; without probabilities the score-based ones are left out."""
    classes = classes_of(pipeline)
    scored = scored_rows(rows, pipeline, target)
    matrix = E.confusion(scored)
    tables = {
        "confusion": matrix,
        "confusion_shares": E.confusion_shares(matrix),
        "classification_report": E.classification_report(matrix),
        "main_confusion": E.main_confusion(matrix),
        "metrics": E.metric_row(matrix).withColumn("macro_auc", F.lit(None).cast("double")),
    }
    if "p_0" in scored.columns:
        probabilities = _probabilities(pipeline)
        aucs = E.auc_per_class(scored, probabilities)
        tables |= {
            "auc": aucs,
            "roc": E.roc_points(scored, probabilities),
            "metrics": E.metrics_with_auc(matrix, aucs, classes),
            "confidence_gap": E.confidence_gap(scored, list(probabilities.values())),
        }
    if out:
        for name, table in tables.items():
            write_report(table, f"{out}/{name}")
        write_improvement_log(E.improvement_log(matrix), f"{out}/improvement_log")
    return tables
