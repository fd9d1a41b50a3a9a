"""Candidate estimators, tuned-model factory, split counts."""

from __future__ import annotations

import math
from typing import Any

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.functions.features import feature_names
from tracklab.operators.boosting import JointBoosting, JointBoostingModel
from tracklab.operators.forest import Forest, ForestModel
from tracklab.operators.knn import KnnClassifier
from tracklab.operators.perceptron import Perceptron
from tracklab.operators.small import literal_table
from tracklab.operators.svm import SquaredHingeSVC
from tracklab.session import scratch_dir

WIDTH = len(feature_names())
DEEPEST_TREE = 30  # limit of the tree learners


def label_indexer(column: str) -> StringIndexer:
    """Codes in alphabetical class order; an unseen label is an error."""
    return StringIndexer(inputCol=column, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error")


def label_decoder(labels: list[str]) -> IndexToString:
    return IndexToString(inputCol="prediction", outputCol="predicted_genre", labels=labels)


def candidate_models(rows: int, classes: int, width: int = WIDTH, rounds: int = 200,
                     svm_steps: int = 2000) -> dict[str, Estimator]:
    """The six compared classifiers for ``rows`` training rows and ``classes`` classes.

    ``rows`` are those of one fit, in cross-validation without the held-out fold: the penalty
    of the linear models is given per row here, hence 1 / rows.
    """
    per_row = 1.0 / rows
    return {
        "Logistic Regression": LogisticRegression(
            family="multinomial", maxIter=500, regParam=per_row, elasticNetParam=0.0, standardization=False,
            tol=1e-4),
        "Random Forest": Forest(numTrees=100, maxDepth=DEEPEST_TREE),
        "SVM": SquaredHingeSVC(cost=1.0, maxIter=svm_steps),
        "KNN": KnnClassifier(k=7),
        "MLP": Perceptron(hidden=[128, 64], maxIter=200),
        "Gradient Boosting": JointBoosting(maxIter=rounds),
    }


def boosting_from(params: dict[str, Any]) -> JointBoosting:
    """Boosted trees; a depth that is not positive is no limit."""
    return JointBoosting(
        maxIter=params.get("n_estimators", 1000), stepSize=float(params.get("learning_rate", 0.1)),
        numLeaves=params.get("num_leaves", 31), maxDepth=max(params.get("max_depth", -1), 0),
        minInstancesPerNode=params.get("min_child_samples", 20), subsamplingRate=float(params.get("subsample", 0.8)),
        columnsRate=float(params.get("colsample_bytree", 1.0)), regAlpha=float(params.get("reg_alpha", 0.0)),
        regLambda=float(params.get("reg_lambda", 0.0)),
    )


def forest_from(params: dict[str, Any]) -> Forest:
    """A forest; no depth, or none, is as deep as the tree learners go."""
    return Forest(
        numTrees=params.get("n_estimators", 100), maxDepth=min(params.get("max_depth") or DEEPEST_TREE, DEEPEST_TREE),
        minInstancesPerNode=params.get("min_samples_leaf", 1), minSplitRows=params.get("min_samples_split", 2),
        featureSubsetStrategy=params.get("max_features", "sqrt"),
    )


def perceptron_from(params: dict[str, Any], rounds: int = 300) -> Perceptron:
    """A perceptron whose hidden layers are n_layers with n_units_l0, n_units_l1, ..."""
    hidden = [params[f"n_units_l{i}"] for i in range(params["n_layers"])] if "n_layers" in params else [128, 64]
    return Perceptron(hidden=hidden, maxIter=rounds, stepSize=float(params.get("lr_init", 1e-3)), penalty=float(params.get("alpha", 1e-4)))


def tuned_model(name: str, params: dict[str, Any], classes: int) -> Estimator:
    """The final estimator for the winning candidate; unknown names are an error."""
    if "Boosting" in name:
        return boosting_from(params)
    if "Random Forest" in name:
        return forest_from(params)
    if "MLP" in name:
        return perceptron_from(params)
    raise ValueError(f"no tuned model for {name!r}")


def fit_final(estimator: Estimator, df: DataFrame, include_validation: bool = True) -> Model:
    """Fit on train plus validation rows (or train only) of a split table."""
    splits = ["train", "val"] if include_validation else ["train"]
    return estimator.fit(df.filter(F.col("split").isin(splits)))


def split_counts(spark, model: Transformer, names: list[str] | None = None) -> DataFrame:
    """(feature, importance, original): how many tree splits use each feature.

    Counted over the model's node table, for MLlib's trees the one that they are stored as.
    """
    names = names or feature_names()
    if isinstance(model, (ForestModel, JointBoostingModel)):
        used = model.node_table(spark).filter("feature >= 0").select("feature")
    else:
        path = scratch_dir(spark, "tree-nodes")
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data")
        node = "nodeData." if "nodeData" in nodes.columns else ""
        used = nodes.filter(f"{node}leftChild >= 0").select(F.col(f"{node}split.featureIndex").alias("feature"))
    counts = used.groupBy("feature").agg(F.count("*").alias("importance"))
    known = literal_table(spark, [(i, n, n in S.FEATURES) for i, n in enumerate(names)], "place int, name string, original boolean")
    return known.join(counts, known["place"] == counts["feature"], "left").select(
        F.col("name").alias("feature"), F.coalesce("importance", F.lit(0).cast("long")).alias("importance"), "original",
    ).orderBy(F.desc("importance"), "feature")
