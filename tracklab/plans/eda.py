"""The profiling run: every EDA table of a track frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators.cleaning import numeric_columns
from tracklab.operators.mutual_info import knn_mi, top_features
from tracklab.operators.profile import class_balance, missing_counts, moments, value_counts
from tracklab.operators.small import small_rows
from tracklab.operators.split import sampled_classes


def mutual_info(df: DataFrame, target: str) -> DataFrame:
    """(feature, mutual_info) of the numeric features, null cells counted as 0."""
    features = numeric_columns(df, among=S.FEATURES)
    return knn_mi(df.na.fill(0, subset=features), features, target)


def pairplot_rows(df: DataFrame, target: str, scores: DataFrame, n: int = 4, classes: int = 10) -> DataFrame:
    """The n most informative features and the target, for at most ``classes`` classes (M5)."""
    best = [r["feature"] for r in small_rows(top_features(scores, n))]
    return df.join(F.broadcast(sampled_classes(df, target, classes)), target, "left_semi").select(*best, target)


def eda_summary(df: DataFrame, target: str, scores: DataFrame | None = None) -> DataFrame:
    """All report tables in long form: section, key, metric, value."""
    features = numeric_columns(df, among=S.FEATURES)
    scores = mutual_info(df, target) if scores is None else scores
    balance = class_balance(df, target)
    missing = missing_counts(df)
    counts = value_counts(df, target)
    stats = moments(df, features)

    def section(name, table, key, metrics):
        return table.select(F.lit(name).alias("section"), F.col(key).alias("key"), F.inline(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
        ])))

    overview = balance.select(
        F.lit("table").alias("name"), "*", F.lit(df.count()).alias("rows"), F.lit(len(df.columns)).alias("columns"),
    ).withColumn("missing", F.coalesce(missing.agg(F.sum("missing_count")).scalar(), F.lit(0)))
    parts = [
        section("overview", overview, "name",
                ["rows", "columns", "missing", "n_classes", "min_count", "max_count", "balanced"]),
        section("target", counts, "label", ["count", "percentage"]),
        section("missing", missing, "column", ["missing_count"]),
        section("statistics", stats, "feature", ["mean", "std", "min", "max", "skew", "kurtosis"]),
        section("importance", scores, "feature", ["mutual_info"]),
    ]
    return reduce(DataFrame.unionByName, parts)
