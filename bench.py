"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores.  ``cv_*`` entries are 3-fold cross-validation of one model on the 10,000-row
stratified subsample with 42 scaled features.  Models are fitted once and kept: ``batch_predict``
is scoring alone, ``fit_forest`` the fit before it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tracklab.operators import models, tuning
from tracklab.plans.catalogue import QUERIES
from tracklab.plans.queries_train import _fitted_rows, _pipeline, _prepared, _search_rows
from tracklab.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
HEADLINES = [
    "target_summary", "super_genre_counts", "describe_stats", "skew_kurtosis", "corr_pairs", "iqr_fences",
    "winsorised", "histogram", "kde_grid", "target_candidates", "engineered_features", "stratified_split",
    "kfold_assign", "mi_discrete", "mi_knn", "mood_labels", "top_tracks_per_genre", "classification_report",
    "auc_per_class", "topk_classes", "top1_boxplot", "knn_vote", "batch_predict",
]
COMPARED = {"cv_logistic_regression": "Logistic Regression", "cv_random_forest": "Random Forest", "cv_svm": "SVM", "cv_knn": "KNN",
            "cv_mlp": "MLP", "cv_boosting": "Gradient Boosting"}


def timed(times: dict, name: str, run) -> None:
    start = time.perf_counter()
    run()
    times[name] = round(time.perf_counter() - start, 3)
    print(f"{name} {times[name]}", file=sys.stderr, flush=True)


def main() -> None:
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), app="tracklab-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINES:
        if name == "batch_predict":
            timed(times, "prepare_model_rows", lambda: _prepared(spark, SF_DIR))
            timed(times, "fit_forest", lambda: _pipeline(spark, SF_DIR))
        timed(times, name, lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    rows = _search_rows(spark, SF_DIR)
    candidates = models.candidate_models(_fitted_rows(rows), 6)
    for name, model in COMPARED.items():
        timed(times, name, lambda: tuning.cross_validate([candidates[model]], rows))
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
