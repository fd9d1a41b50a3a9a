"""Classification metrics from one confusion aggregate, exact ROC and AUC."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracklab import schema as S
from tracklab.functions.features import top_gap
from tracklab.operators.ordered import quantiles, running_totals
from tracklab.operators.small import checked_broadcast, div, literal_table, local_if_small, small_rows
from tracklab.sources.staging import stage


def confusion(df: DataFrame, truth: str = "y_true", pred: str = "y_pred",
              labels: Sequence[str] | None = None) -> DataFrame:
    """(y_true, y_pred, n) for every pair of labels, zeros included.

    Without ``labels``, those seen in either column.  Rows without a truth are left out; a
    missing prediction is an error of its class, counted in rows whose y_pred is null.  The
    grid is made by Spark from the list of labels.
    """
    counts = local_if_small(
        df.filter(F.col(truth).isNotNull()).groupBy(F.col(truth).alias("y_true"), F.col(pred).alias("y_pred"))
        .agg(F.count("*").alias("n"))
    )
    if labels is None:
        seen = counts.select(F.explode(F.array("y_true", "y_pred")).alias("l")).filter("l is not null").distinct()
        labels = sorted(r["l"] for r in small_rows(seen))
    kind = df.schema[truth].dataType.simpleString()
    known = literal_table(df.sparkSession, [(a,) for a in labels], f"y_true {kind}")
    grid = known.withColumn("y_pred", F.explode(F.array(*[F.lit(b).cast(kind) for b in labels]))) if labels else (
        known.withColumn("y_pred", F.lit(None).cast(kind)))
    none = counts.filter("y_pred is null").join(known, "y_true", "left_semi")
    return grid.join(counts, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n")
    ).unionByName(none.select("y_true", "y_pred", "n"))


def confusion_shares(matrix: DataFrame) -> DataFrame:
    """Each row of the matrix divided by its sum; null for a class without rows."""
    total = F.sum("n").over(W.partitionBy("y_true"))
    return matrix.select("y_true", "y_pred", div(F.col("n"), total).alias("share"))


def per_class(matrix: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support, tp, predicted); 0 where undefined."""
    pairs = matrix.select(F.inline(F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )))
    sums = pairs.filter("label is not null").groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    zero = F.lit(0.0)
    return sums.select(
        "label",
        F.coalesce(div(F.col("tp"), F.col("predicted")), zero).alias("precision"),
        F.coalesce(div(F.col("tp"), F.col("support")), zero).alias("recall"),
        F.coalesce(div(F.col("tp") * 2, F.col("predicted") + F.col("support")), zero).alias("f1"),
        "support", "tp", "predicted",
    )


def _averages(classes: DataFrame) -> DataFrame:
    support = F.sum("support")
    names = ("precision", "recall", "f1")
    return classes.agg(
        div(F.sum("tp"), support).alias("accuracy"),
        support.alias("n"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[div(F.sum(F.col(c) * F.col("support")), support).alias(f"weighted_{c}") for c in names],
    )


def classification_report(matrix: DataFrame) -> DataFrame:
    """Per-class rows, then accuracy, macro avg and weighted avg rows."""
    classes = per_class(matrix)
    names = ("precision", "recall", "f1")
    acc = F.col("accuracy")
    summary = _averages(classes).select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), acc.alias("precision"), acc.alias("recall"),
                 acc.alias("f1"), F.col("n").alias("support")),
        *[F.struct(F.lit(f"{kind} avg").alias("label"),
                   *[F.col(f"{kind}_{c}").alias(c) for c in names], F.col("n").alias("support"))
          for kind in ("macro", "weighted")],
    )))
    return classes.select("label", *names, "support").unionByName(summary)


def metric_row(matrix: DataFrame, target: float = S.TARGET_ACCURACY) -> DataFrame:
    """One row: accuracy, weighted_f1, macro_f1, target_met, gap (null when met)."""
    acc = F.col("accuracy")
    return _averages(per_class(matrix)).select(
        "accuracy", "weighted_f1", "macro_f1", (acc >= target).alias("target_met"),
        F.when(acc < target, F.lit(target) - acc).alias("gap"),
    )


def metric_table(matrix: DataFrame, macro_auc: float | None) -> DataFrame:
    """(metric, value) rows for side-by-side comparison."""
    auc = F.lit(macro_auc).cast("double")
    return metric_row(matrix).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in (
            ("accuracy", F.col("accuracy")), ("weighted_f1", F.col("weighted_f1")),
            ("macro_f1", F.col("macro_f1")), ("macro_auc", auc))
    ])))


def main_confusion(matrix: DataFrame) -> DataFrame:
    """(y_true, correct, total, recall, confused_with, confused_n): the largest error per class."""
    totals = matrix.groupBy("y_true").agg(
        F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("correct"),
        F.sum("n").alias("total"),
    )
    first = F.row_number().over(W.partitionBy("y_true").orderBy(F.desc("n"), "y_pred"))
    errors = (
        matrix.filter("y_true <> y_pred and n > 0").withColumn("_rank", first).filter("_rank = 1")
        .select("y_true", F.col("y_pred").alias("confused_with"), F.col("n").alias("confused_n"))
    )
    return totals.join(errors, "y_true", "left").select(
        "y_true", "correct", "total", div(F.col("correct"), F.col("total")).alias("recall"),
        "confused_with", "confused_n",
    )


def class_scores(df: DataFrame, probabilities: dict[str, str], truth: str = "y_true") -> DataFrame:
    """(class, score, y): one-vs-rest rows, map-only."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("class"), F.col(p).cast("double").alias("score"),
                 (F.col(truth) == c).cast("long").alias("y"))
        for c, p in probabilities.items()
    ])))


def _score_counts(df, probabilities, truth):
    """Positives and negatives of scores, staged: later passes read only these.

    Ties are counted batch by batch, without a shuffle or a table of scores in a task; those of different
    batches are summed where the scores are sorted.
    """
    def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(["class", "score"]).aggregate([("y", "sum"), ("y", "count")])
            negative = pc.subtract(found["y_count"], found["y_sum"])
            yield from pa.table([found["class"], found["score"], found["y_sum"], negative], ["class", "score", "pos", "neg"]).to_batches()

    known = class_scores(df, probabilities, truth).filter("score is not null")
    return stage(known.mapInArrow(tied, "class string, score double, pos long, neg long"), "score-counts")


def roc_points(df: DataFrame, probabilities: dict[str, str], truth: str = "y_true",
               plain_rows: int | None = None) -> DataFrame:
    """(class, threshold, fpr, tpr) at every distinct score; threshold null at the origin."""
    counts = _score_counts(df, probabilities, truth).select("class", (-F.col("score")).alias("_down"), "pos", "neg")
    totals = checked_broadcast(
        counts.groupBy("class").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    )
    points = (
        running_totals(counts, ["class"], "_down", {"_tp": "pos", "_fp": "neg"}, plain_rows, ["pos", "neg"])
        .join(totals, "class")
        .select("class", (F.lit(0.0) - F.col("_down")).alias("threshold"),
                div(F.col("_fp"), F.col("_n")).alias("fpr"), div(F.col("_tp"), F.col("_p")).alias("tpr"))
    )
    origin = totals.select("class", F.lit(None).cast("double").alias("threshold"),
                           F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(points)


def auc_per_class(df: DataFrame, probabilities: dict[str, str], truth: str = "y_true",
                  plain_rows: int | None = None) -> DataFrame:
    """(class, auc): the share of (positive, negative) pairs ranked right, ties half."""
    counts = _score_counts(df, probabilities, truth)
    ranked = running_totals(counts, ["class"], "score", {"_upto": "neg"}, plain_rows, ["pos", "neg"])
    below = F.col("_upto") - F.col("neg") / 2
    sums = ranked.groupBy("class").agg(
        F.sum(F.col("pos") * below).alias("_wins"),
        F.sum("pos").cast("double").alias("_p"), F.sum("neg").cast("double").alias("_n"),
    )
    return sums.select("class", div(F.col("_wins"), F.col("_p") * F.col("_n")).alias("auc"))


def macro_auc(aucs: DataFrame, classes: Sequence[str]) -> DataFrame:
    """One row with the mean AUC; null when a class has no AUC."""
    return aucs.agg(
        F.when(F.count("auc") == len(classes), F.avg("auc")).alias("macro_auc")
    )


def metrics_with_auc(matrix: DataFrame, aucs: DataFrame, classes: Sequence[str]) -> DataFrame:
    """The one-row evaluation summary."""
    macro = macro_auc(aucs, classes).first()["macro_auc"]
    return metric_row(matrix).withColumn("macro_auc", F.lit(macro).cast("double"))


def improvement_log(matrix: DataFrame, attempts: Sequence[str] = ()) -> DataFrame:
    """(accuracy, gap, attempt) rows while the accuracy target is missed, else no rows."""
    notes = list(attempts) or ["none so far"]
    return metric_row(matrix).filter(~F.col("target_met")).select(
        "accuracy", "gap", F.explode(F.array(*[F.lit(n) for n in notes])).alias("attempt")
    )


def confidence_gap(df: DataFrame, probabilities: Sequence[str], truth: str = "y_true",
                   pred: str = "y_pred") -> DataFrame:
    """One row: mean top-1 minus top-2 gap for all, correct and wrong rows, median top-1."""
    p = F.array(*probabilities)
    rows = df.select(top_gap(p).alias("gap"), F.array_max(p).alias("top1"),
                     (F.col(truth) == F.col(pred)).alias("hit"))
    means = rows.agg(
        F.avg("gap").alias("mean_gap"),
        F.avg(F.when(F.col("hit"), F.col("gap"))).alias("mean_gap_correct"),
        F.avg(F.when(~F.col("hit"), F.col("gap"))).alias("mean_gap_incorrect"),
    )
    median = quantiles(rows, ["top1"], [0.5]).first()
    return means.withColumn("median_top1", F.lit(median["value"] if median else None).cast("double"))


def class_shares(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """(split, class, n, share): class proportions inside each split."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(split, label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(split))
    return counts.select(split, F.col(label).alias("class"), "n", div(F.col("n"), total).alias("share"))


def share_drift(df: DataFrame, label: str, split: str = "split", tolerance: float = 0.03) -> DataFrame:
    """(class, train_share, test_share, drift, within): train against test shares."""
    shares = class_shares(df, label, split)

    def share(name):
        return F.coalesce(F.max(F.when(F.col(split) == name, F.col("share"))), F.lit(0.0))

    wide = shares.groupBy("class").agg(share("train").alias("train_share"), share("test").alias("test_share"))
    drift = F.abs(F.col("train_share") - F.col("test_share"))
    return wide.select("class", "train_share", "test_share", drift.alias("drift"),
                       (drift <= tolerance).alias("within"))
