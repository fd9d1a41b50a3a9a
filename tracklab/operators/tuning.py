"""Cross-validated comparison, grid search, sequential and random search."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators import parzen
from tracklab.operators.models import boosting_from, forest_from, perceptron_from
from tracklab.operators.profile import running_best
from tracklab.operators.small import literal_table, small_rows

# Fits running side by side.
PARALLELISM = 8

# Parameters kept constant during the grid search.
GRID_FIXED = {
    "Boosting": {"n_estimators": 100, "min_child_samples": 20, "colsample_bytree": 0.8,
                 "subsample": 0.8},
    "Random Forest": {"n_estimators": 150},
}
# Grids.
GRIDS = {
    "Boosting": {"num_leaves": [63, 127], "learning_rate": [0.05, 0.1]},
    "Random Forest": {"max_depth": [10, 20, 30], "min_samples_leaf": [1, 2, 5], "max_features": ["sqrt", "log2"]},
}
# Search ranges.  Kinds: ("int", low, high), ("float", low, high), ("log", low, high),
# ("one", choices); sizes of layers are drawn for the layers that there are.
RANGES = {
    "Boosting": {
        "n_estimators": ("int", 100, 500), "learning_rate": ("log", 0.02, 0.3), "num_leaves": ("int", 31, 127),
        "max_depth": ("int", 3, 10), "min_child_samples": ("int", 10, 100), "subsample": ("float", 0.6, 1.0),
        "colsample_bytree": ("float", 0.6, 1.0), "reg_alpha": ("log", 1e-8, 5.0), "reg_lambda": ("log", 1e-8, 5.0),
    },
    "Random Forest": {
        "n_estimators": ("int", 50, 300), "max_depth": ("int", 5, 25), "min_samples_split": ("int", 2, 20),
        "min_samples_leaf": ("int", 1, 10), "max_features": ("one", ["sqrt", "log2"]),
    },
    "MLP": {
        "n_layers": ("int", 1, 3), "n_units_l0": ("int", 64, 256), "n_units_l1": ("int", 64, 256),
        "n_units_l2": ("int", 64, 256), "alpha": ("log", 1e-5, 1e-1), "lr_init": ("log", 1e-4, 1e-1),
    },
}


def _family(name: str, known: dict) -> str:
    for family in known:
        if family in name:
            return family
    raise ValueError(f"{name!r} cannot be tuned; supported: {', '.join(known)}")


def _builder(family: str) -> Callable[[dict], Estimator]:
    return {"Boosting": boosting_from, "Random Forest": forest_from, "MLP": lambda p: perceptron_from(p, rounds=200)}[family]


def _keep(df: DataFrame, rows_per_task: int = 50_000) -> DataFrame:
    """The fold table is read by every fit: label, features and fold, in tasks worth starting.

    Iterative solvers run one job per step, so a small sample is faster in few tasks.
    """
    table = df.select("features", "label", "fold")
    tasks = max(1, math.ceil(df.count() / rows_per_task))
    if tasks < df.sparkSession.sparkContext.defaultParallelism:
        table = table.coalesce(tasks)
    return table.persist(StorageLevel.MEMORY_AND_DISK)


def fold_metrics(counts: Sequence[tuple[float, float, int]]) -> tuple[float, float]:
    """Accuracy and weighted F1 of (label, prediction, rows) counts, a row per pair of classes."""
    total = sum(n for *_, n in counts)
    f1 = 0.0
    for c in {label for label, *_ in counts}:
        support = sum(n for a, _, n in counts if a == c)
        both = sum(n for a, b, n in counts if a == b == c)
        f1 += support * 2 * both / (support + sum(n for _, b, n in counts if b == c))
    return (sum(n for a, b, n in counts if a == b) / total, f1 / total) if total else (0.0, 0.0)


def _fold_score(estimator: Estimator, table: DataFrame, fold: int) -> tuple[float, float, float]:
    """Accuracy, weighted F1 and seconds of one fold, from one aggregate over its rows."""
    start = time.perf_counter()
    model = estimator.fit(table.filter(F.col("fold") != fold))
    scored = model.transform(table.filter(F.col("fold") == fold))
    counts = small_rows(scored.groupBy("label", "prediction").count())
    return *fold_metrics([tuple(r) for r in counts]), time.perf_counter() - start


def cross_validate(estimators: Sequence[Estimator], df: DataFrame, folds: int = S.CV_FOLDS,
                   parallelism: int = PARALLELISM) -> list[tuple[float, float, float]]:
    """Mean accuracy, mean weighted F1 and total seconds per estimator.

    Fits of different estimators and folds are independent jobs and run side by side.
    """
    table = _keep(df)
    try:
        table.count()
        with ThreadPool(parallelism) as pool:
            return _mean_scores(estimators, table, folds, pool)
    finally:
        table.unpersist()


def _mean_scores(estimators: Sequence[Estimator], table: DataFrame, folds: int, pool: ThreadPool) -> list[tuple[float, float, float]]:
    scores = pool.starmap(_fold_score, [(e, table, j) for e in estimators for j in range(folds)], chunksize=1)
    results = []
    for i in range(len(estimators)):
        accuracy, f1, seconds = zip(*scores[i * folds:(i + 1) * folds])
        results.append((sum(accuracy) / folds, sum(f1) / folds, sum(seconds)))
    return results


def compare_models(models: dict[str, Estimator], df: DataFrame, folds: int = S.CV_FOLDS,
                   parallelism: int = PARALLELISM) -> DataFrame:
    """(model, mean_cv_accuracy, mean_f1_weighted, train_time_s), best F1 first."""
    scores = cross_validate(list(models.values()), df, folds, parallelism)
    rows = [(name, round(accuracy, 4), round(f1, 4), round(seconds, 2))
            for name, (accuracy, f1, seconds) in zip(models, scores)]
    return literal_table(
        df.sparkSession, rows,
        "model string, mean_cv_accuracy double, mean_f1_weighted double, train_time_s double",
    ).orderBy(F.desc("mean_f1_weighted"), "model")


def best_model(comparison: DataFrame) -> str:
    """The model with the highest weighted F1."""
    return comparison.orderBy(F.desc("mean_f1_weighted"), "model").first()["model"]


def _trials(df: DataFrame, build: Callable[[dict], Estimator], candidates: Sequence[dict[str, Any]],
            folds: int) -> list[tuple[dict, float]]:
    scores = cross_validate([build(p) for p in candidates], df, folds)
    return [(p, f1) for p, (_, f1, _) in zip(candidates, scores)]


def grid_search(name: str, df: DataFrame, classes: int, width: int, folds: int = S.CV_FOLDS,
                grid: dict[str, list] | None = None, fixed: dict[str, Any] | None = None
                ) -> tuple[dict[str, Any], float, list]:
    """Best parameters (fixed ones merged in), best weighted F1 and all trials."""
    family = _family(name, GRIDS)
    grid = GRIDS[family] if grid is None else grid
    fixed = GRID_FIXED[family] if fixed is None else fixed
    points = [fixed | dict(zip(grid, values)) for values in product(*grid.values())]
    trials = _trials(df, _builder(family), points, folds)
    best, score = max(trials, key=lambda t: t[1])
    return best, score, trials


def sample_params(family: str, trials: int = S.SEARCH_TRIALS, seed: int = S.SEED) -> list[dict[str, Any]]:
    """Parameter sets drawn from the ranges of a family; the same seed gives the same sets."""
    rng = random.Random(seed)

    def draw(kind, *args):
        if kind == "int":
            return rng.randint(*args)
        if kind == "float":
            return rng.uniform(*args)
        if kind == "log":
            return math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
        return rng.choice(args[0])

    return [{p: draw(*spec) for p, spec in RANGES[family].items()} for _ in range(trials)]


def random_search(name: str, df: DataFrame, classes: int, width: int, trials: int = S.SEARCH_TRIALS,
                  folds: int = S.CV_FOLDS, candidates: Sequence[dict] | None = None
                  ) -> tuple[dict[str, Any], float, list]:
    """Best parameters, best weighted F1 and all trials of a seeded search (T4)."""
    family = _family(name, RANGES)
    points = sample_params(family, trials) if candidates is None else list(candidates)
    results = _trials(df, _builder(family), points, folds)
    best, score = max(results, key=lambda t: t[1])
    return best, score, results


def sequential_search(name: str, df: DataFrame, trials: int = S.SEARCH_TRIALS, folds: int = S.CV_FOLDS, seed: int = S.SEED,
                      side_by_side: int = 3) -> tuple[dict[str, Any], float, list]:
    """Best parameters, best weighted F1 and all trials of a search that learns from its trials (T4).

    ``side_by_side`` trials run at a time, each with its folds side by side.
    """
    family = _family(name, RANGES)
    build, table = _builder(family), _keep(df)
    try:
        table.count()
        with ThreadPool(folds * side_by_side) as pool:
            results = parzen.search(RANGES[family], lambda p: _mean_scores([build(p)], table, folds, pool)[0][1], trials, seed, side_by_side)
    finally:
        table.unpersist()
    best, score = max(results, key=lambda t: t[1])
    return best, score, results


def trial_history(spark, trials: Sequence[tuple[dict, float]], baseline: float) -> DataFrame:
    """(trial, score, best, improvement): running best and its gain over the baseline (T5)."""
    rows = [(i, score) for i, (_, score) in enumerate(trials)]
    history = running_best(literal_table(spark, rows, "trial int, score double"), "trial", "score")
    return history.withColumn("improvement", F.col("best") - F.lit(float(baseline)))
