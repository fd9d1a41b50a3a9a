"""The training run: clean, split, preprocess, compare, tune, fit, save (stages 1-13)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators import models as M
from tracklab.operators import tuning as U
from tracklab.operators.cleaning import features_and_target, prepare
from tracklab.operators.infer import bundle
from tracklab.operators.small import literal_table, small_rows
from tracklab.operators.split import split_by, split_cuts, stratified_folds, stratified_sample
from tracklab.operators.stages import preprocessor
from tracklab.sources.files import write_report, write_splits
from tracklab.sources.staging import stage


@dataclass
class Prepared:
    """Split rows as they came, the fitted preprocessor and the class list.

    ``rows``, with scaled features and codes, follow from these in one map-only step.
    """
    split: DataFrame
    preprocessor: PipelineModel
    labels: list[str]
    target: str
    ids: list[str]

    def modelled(self, df: DataFrame) -> DataFrame:
        """Scaled features and codes of some of the split rows, with their other columns."""
        coded = StringIndexerModel.from_labels(self.labels, inputCol=self.target, outputCol="label", handleInvalid="error")
        more = [c for c in df.columns if c not in {*self.ids, self.target, *S.FEATURES}]
        return coded.transform(self.preprocessor.transform(df)).select(*self.ids, self.target, *more, "label", "features")

    @property
    def rows(self) -> DataFrame:
        return self.modelled(self.split)


def clean_rows(df: DataFrame, target: str, ids: list[str], mapped: bool = False) -> DataFrame:
    """Ids, model inputs and target of the rows that have one."""
    clean = df.filter(F.col(target).isNotNull()) if mapped else prepare(df, target)
    return features_and_target(clean, target, keep=ids)


def prepared(clean: DataFrame, target: str, ids: list[str], cuts: dict[str, list[str]] | None = None,
             fitted: PipelineModel | None = None) -> Prepared:
    """Split and preprocessor of a staged table; the scaler sees training rows only.

    Neither keys nor scaled rows are written: the table is read again for them.
    """
    cuts = cuts or split_cuts(clean, target, ids, reread=True)
    split = split_by(clean, target, ids, cuts)
    fitted = fitted or preprocessor().fit(split.filter("split = 'train'"))
    return Prepared(split, fitted, sorted(cuts), target, ids)


def prepared_rows(df: DataFrame, target: str, ids: list[str], mapped: bool = False) -> Prepared:
    """Cleaned, split, engineered and scaled rows; the cleaned rows are staged, every later fit reads them."""
    return prepared(stage(clean_rows(df, target, ids, mapped), "clean-rows"), target, ids)


def folds_for_search(prepared: Prepared, target: str, ids: list[str], rows: int = S.CV_SUBSAMPLE,
                     folds: int = S.CV_FOLDS) -> DataFrame:
    """Stratified subsample of the training rows with a fold number (M2, M3)."""
    train = prepared.split.filter("split = 'train'")
    sample = stage(stratified_sample(train, target, ids, rows, reread=True), "search-sample")
    return stage(prepared.modelled(stratified_folds(sample, target, ids, folds)), "search-rows")


def selection_report(spark, comparison: DataFrame, best: str, params: dict, baseline: float,
                     tuned: float) -> DataFrame:
    """Ranking, improvement and parameters as rows: section, key, metric, value."""
    rows = [("improvement", best, "baseline_f1", str(baseline)), ("improvement", best, "tuned_f1", str(tuned)),
            ("improvement", best, "gain", str(round(tuned - baseline, 4)))]
    rows += [("parameter", k, "value", str(v)) for k, v in params.items()]
    for rank, r in enumerate(small_rows(comparison), 1):
        rows += [("ranking", r["model"], m, str(r[m])) for m in ("mean_cv_accuracy", "mean_f1_weighted", "train_time_s")]
        rows.append(("ranking", r["model"], "rank", str(rank)))
        rows.append(("ranking", r["model"], "selected", str(r["model"] == best).lower()))
    return literal_table(spark, rows, "section string, key string, metric string, value string")


def train(df: DataFrame, target: str, ids: list[str], out: str, trials: int = S.SEARCH_TRIALS,
          rounds: int = 200, use_grid: bool = False, include_validation: bool = True) -> PipelineModel:
    """The whole run; writes splits, model and report below ``out`` and returns the scoring pipeline."""
    spark = df.sparkSession
    prepared = prepared_rows(df, target, ids)
    rows = stage(prepared.rows, "model-rows")
    write_splits(rows, f"{out}/splits")
    search = folds_for_search(prepared, target, ids)
    classes, n = len(prepared.labels), search.count()
    width = len(rows.select("features").first()[0])
    comparison = U.compare_models(M.candidate_models(n * (S.CV_FOLDS - 1) // S.CV_FOLDS, classes, width, rounds), search)
    best = U.best_model(comparison)
    baseline = comparison.filter(F.col("model") == best).first()["mean_f1_weighted"]
    if use_grid:
        params, tuned, _ = U.grid_search(best, search, classes, width)
    else:
        params, tuned, _ = U.sequential_search(best, search, trials)
    fitted = M.fit_final(M.tuned_model(best, params, classes), rows, include_validation)
    scoring = bundle(prepared.preprocessor, fitted, M.label_decoder(prepared.labels))
    scoring.write().overwrite().save(f"{out}/model")
    write_report(selection_report(spark, comparison, best, params, baseline, tuned), f"{out}/model_selection")
    return scoring
