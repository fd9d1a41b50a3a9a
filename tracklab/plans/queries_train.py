"""Registered queries: model comparison, search, training and scoring.

Fitted models depend on solver details, so queries on them have no oracle or one of
invariants; scoring itself is compared by value with a small hand-written model.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.functions.features import feature_names
from tracklab.operators import infer, models, recommend, tuning
from tracklab.operators.boosting import JointBoostingModel
from tracklab.operators.cleaning import numeric_columns
from tracklab.operators.metrics import confusion
from tracklab.operators.small import literal_table
from tracklab.operators.split import split_cuts
from tracklab.operators.stages import scaled_names
from tracklab.plans import evaluation, training
from tracklab.plans.oracle_views import CLASSES, PLAYLISTS, on_tracks, values
from tracklab.plans.queries_model import _SCALED as SCALED_SQL
from tracklab.plans.queries_model import FEATURE_SQL
from tracklab.plans.registry import query, rounded
from tracklab.session import scratch_dir
from tracklab.sources.artefacts import files_print, kept
from tracklab.sources.tables import joins_in_place, table, tracks

TARGET, IDS = "signal_genre", ["track_id"]
# Rows up to which the cleaned rows are written whether or not their joins shuffle.
WRITTEN_ROWS = 4_000_000


def _source(spark, sf) -> str:
    return files_print(spark, [f"{sf}/{name}.parquet" for name in ("lineitem", "part", "orders")])


def _prepared(spark, sf) -> training.Prepared:
    """Cleaned rows, their cuts and the fitted preprocessor, made once per state of the source files.

    Large tables whose joins shuffle no row are read again instead of being written.
    """
    def clean(busy=False):
        return training.clean_rows(tracks(spark, sf, busy, narrow=True), TARGET, IDS, mapped=True)

    again = table(spark, sf, "lineitem").count() > WRITTEN_ROWS and joins_in_place(spark, sf)

    def rows(folder):
        return clean() if again else spark.read.parquet(f"{folder}/rows")

    def make(folder):
        if not again:
            clean(busy=True).write.parquet(f"{folder}/rows")
        cuts = split_cuts(rows(folder), TARGET, IDS, reread=True)
        made = training.prepared(rows(folder), TARGET, IDS, cuts)
        made.preprocessor.write().save(f"{folder}/preprocessor")
        literal_table(spark, cuts.items(), "label string, cuts array<string>").coalesce(1).write.parquet(f"{folder}/cuts")

    folder = kept(spark, "prepared", [_source(spark, sf), WRITTEN_ROWS], make)
    cuts = {r["label"]: r["cuts"] for r in spark.read.parquet(f"{folder}/cuts").collect()}
    return training.prepared(rows(folder), TARGET, IDS, cuts, PipelineModel.load(f"{folder}/preprocessor"))


def _search_rows(spark, sf):
    def make(folder):
        training.folds_for_search(_prepared(spark, sf), TARGET, IDS).write.parquet(folder)

    return spark.read.parquet(kept(spark, "search-rows", [_source(spark, sf), S.CV_SUBSAMPLE, S.CV_FOLDS], make))


def _fitted_rows(rows) -> int:
    """Rows that one fold's fit sees."""
    return rows.count() * (S.CV_FOLDS - 1) // S.CV_FOLDS


def _pipeline(spark, sf) -> PipelineModel:
    """The full forest candidate fitted on train plus validation rows; scoring only loads it."""
    def make(folder):
        prepared = _prepared(spark, sf)
        rows = prepared.rows.filter("split IN ('train', 'val')").count()
        forest = models.candidate_models(rows, len(S.CLASSES))["Random Forest"]
        fitted = models.fit_final(forest, prepared.rows)
        infer.bundle(prepared.preprocessor, fitted, models.label_decoder(prepared.labels)).write().save(folder)

    return PipelineModel.load(kept(spark, "forest", [_source(spark, sf)], make))


def _comparison(spark, sf):
    """All six candidates, compared once per state of the source files."""
    def make(folder):
        rows = _search_rows(spark, sf)
        candidates = models.candidate_models(_fitted_rows(rows), len(S.CLASSES))
        tuning.compare_models(candidates, rows).coalesce(1).write.parquet(folder)

    found = spark.read.parquet(kept(spark, "comparison", [_source(spark, sf)], make))
    return found.orderBy(F.desc("mean_f1_weighted"), "model")


@query()
def cv_comparison(spark, sf):
    """All six candidates by 3-fold cross-validation, with their default rounds and steps."""
    return _comparison(spark, sf)


@query()
def best_model(spark, sf):
    """The first row of the comparison of all six candidates."""
    return _comparison(spark, sf).limit(1)


@query("SELECT CAST(6 AS BIGINT) AS candidates, CAST(6 AS BIGINT) AS known, " + ", ".join(
    f"CAST(0 AS BIGINT) AS {c}" for c in ("bad_score", "below_guessing", "best_not_first")))
def comparison_invariants(spark, sf):
    """What every comparison must satisfy: all candidates, scores from 0 to 1 and above the share of the largest
    class, and a best model that no other beats."""
    compared = _comparison(spark, sf)
    best = best_model(spark, sf).first()
    rows = _search_rows(spark, sf)
    largest = rows.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    scores = F.array("mean_cv_accuracy", "mean_f1_weighted")
    return compared.agg(
        F.count("*").alias("candidates"), F.count_if(F.col("model").isin(*models.candidate_models(1, 2))).alias("known"),
        F.count_if(F.exists(scores, lambda x: x.isNull() | ~x.between(0, 1))).alias("bad_score"),
        F.count_if(F.col("mean_cv_accuracy") < largest).alias("below_guessing"),
        F.count_if(F.col("mean_f1_weighted") > best["mean_f1_weighted"]).alias("best_not_first"))


def _history(spark, sf, name: str, run, baseline: float):
    """Trials of a search, run once per state of the source files, with the running best."""
    def make(folder):
        _, _, trials = run(_search_rows(spark, sf))
        literal_table(spark, [(i, score) for i, (_, score) in enumerate(trials)], "trial int, score double").coalesce(1).write.parquet(folder)

    rows = spark.read.parquet(kept(spark, name, [_source(spark, sf), baseline], make)).orderBy("trial").collect()
    return tuning.trial_history(spark, [({}, r["score"]) for r in rows], baseline=baseline)


def _grid(spark, sf):
    return _history(spark, sf, "grid", lambda rows: tuning.grid_search("Random Forest", rows, len(S.CLASSES), models.WIDTH), 0.0)


@query()
def grid_search(spark, sf):
    """The forest's whole grid."""
    return _grid(spark, sf)


@query()
def random_search(spark, sf):
    """The default number of trials, drawn from the forest's whole ranges."""
    return _history(spark, sf, "random", lambda rows: tuning.random_search("Random Forest", rows, len(S.CLASSES), models.WIDTH), 0.5)


@query()
def sequential_search(spark, sf):
    """The default number of trials over the forest's whole ranges, each proposed from those before it."""
    return _history(spark, sf, "sequential", lambda rows: tuning.sequential_search("Random Forest", rows), 0.5)


@query("SELECT CAST(18 AS BIGINT) AS trials, " + ", ".join(
    f"CAST(0 AS BIGINT) AS {c}" for c in ("bad_score", "falling_best", "best_not_reached", "bad_improvement")))
def grid_search_invariants(spark, sf):
    """What a search's history must satisfy: every grid point, scores from 0 to 1, a best that never falls and is a score."""
    history = _grid(spark, sf)
    before = Window.orderBy("trial")
    seen = history.withColumn("top", F.max("score").over(before)).withColumn("last", F.lag("best").over(before))
    return seen.agg(
        F.countDistinct("trial").alias("trials"), F.count_if(~F.col("score").between(0, 1)).alias("bad_score"),
        F.count_if(F.col("best") < F.col("last")).alias("falling_best"), F.count_if(F.col("best") != F.col("top")).alias("best_not_reached"),
        F.count_if(F.abs(F.col("improvement") - F.col("best")) > 1e-12).alias("bad_improvement"))


@query()
def batch_predict(spark, sf):
    """Every track scored, with a missing input column filled and kept in the output."""
    return infer.score_batch(tracks(spark, sf, busy=True).drop("time_signature"), _pipeline(spark, sf))


@query()
def predict_labels(spark, sf):
    return infer.predict(tracks(spark, sf, busy=True, narrow=True), _pipeline(spark, sf), keep=IDS)


@query()
def predict_proba(spark, sf):
    return infer.predict_proba(tracks(spark, sf, busy=True, narrow=True), _pipeline(spark, sf), keep=IDS)


@query()
def ranked_classes(spark, sf):
    return infer.ranked_classes(tracks(spark, sf, busy=True, narrow=True), _pipeline(spark, sf), IDS, k=3)


@query()
def recommendations_for_batch(spark, sf):
    scored = infer.score_batch(tracks(spark, sf, busy=True), _pipeline(spark, sf))
    return recommend.recommend_playlists(scored.select("track_id", "predicted_genre", "confidence"), "predicted_genre")


@query()
def split_importance(spark, sf):
    return models.split_counts(spark, _pipeline(spark, sf).stages[-2]).limit(25)


@query()
def boosting_predict(spark, sf):
    """The boosted candidate with its default rounds on the search rows, scored on the test split."""
    prepared, rows = _prepared(spark, sf), _search_rows(spark, sf)
    fitted = models.candidate_models(rows.count(), len(S.CLASSES))["Gradient Boosting"].fit(rows)
    scored = fitted.transform(prepared.rows.filter("split = 'test'"))
    return scored.select("track_id", "label", "prediction", F.col("probability").cast("string").alias("probability"))


@query()
def test_set_evaluation(spark, sf):
    """Metric row of the forest on the held-out rows."""
    rows = _prepared(spark, sf).split.filter("split = 'test'")
    return evaluation.metrics(evaluation.scored_rows(rows, _pipeline(spark, sf), TARGET), _pipeline(spark, sf))


@query(on_tracks("SELECT track_id, " + ", ".join(f"round(z_{c}, 6) AS z_{c}" for c in FEATURE_SQL) + " FROM scaled", *SCALED_SQL))
def scaled_inputs(spark, sf):
    """Scaled features of all tracks as the model sees them, cell by cell."""
    features = infer.preprocess(tracks(spark, sf, narrow=True), _prepared(spark, sf).preprocessor, keep=IDS)
    return rounded(infer.cells(features, "features", IDS, scaled_names()), scaled_names())


_INVARIANTS = ("rows_scored", "bad_label", "bad_sum", "not_the_best", "bad_confidence", "filled_not_zero", "bad_rank")


@query("SELECT count(*) AS rows_scored, " + ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in _INVARIANTS[1:]) + " FROM lineitem")
def scoring_invariants(spark, sf):
    """What every scored row must satisfy, as counts of rows that do not: labels are classes, probabilities sum to 1,
    the label is the first best class, the confidence is its rounded percentage, a missing input is filled with 0."""
    pipeline = _pipeline(spark, sf)
    scored = infer.score_batch(tracks(spark, sf, busy=True).drop("time_signature"), pipeline).withColumnsRenamed(
        {"predicted_genre": "said", "confidence": "sure"})
    inputs, said = [c for c in S.FEATURES if c != "time_signature"], ["said", "sure", "filled"]
    chances = infer.predict_proba(scored.withColumn("filled", F.col("time_signature")), pipeline, keep=[*inputs, *said])
    chances = chances.withColumnsRenamed({c: f"p_{c}" for c in S.CLASSES})
    # All three scores beside each other on a row: nothing is joined.
    rows = infer.ranked_classes(chances, pipeline, [*said, *[f"p_{c}" for c in S.CLASSES]], k=1).select(
        F.col("said").alias("predicted_genre"), F.col("sure").alias("confidence"), F.col("filled").alias("time_signature"),
        F.col("class").alias("top"), *[F.col(f"p_{c}").alias(c) for c in S.CLASSES])
    best = F.greatest(*S.CLASSES)
    first = F.coalesce(*[F.when(F.col(c) == best, F.lit(c)) for c in S.CLASSES])
    total = sum((F.col(c) for c in S.CLASSES[1:]), F.col(S.CLASSES[0]))
    return rows.agg(
        F.count("*").alias("rows_scored"), F.count_if(~F.col("predicted_genre").isin(*S.CLASSES)).alias("bad_label"),
        F.count_if(F.abs(total - 1) > 1e-9).alias("bad_sum"), F.count_if(F.col("predicted_genre") != first).alias("not_the_best"),
        F.count_if(F.col("confidence") != F.bround(best * 100, 1)).alias("bad_confidence"),
        F.count_if(F.col("time_signature") != 0).alias("filled_not_zero"), F.count_if(F.col("top") != first).alias("bad_rank"))


@query(on_tracks("SELECT " + ", ".join(f"count({c}) AS {c}" for c in S.FEATURES if c != "explicit") + " FROM tracks"))
def numeric_inputs(spark, sf):
    """Numeric columns by type: booleans are not among them."""
    t = tracks(spark, sf)
    return t.agg(*[F.count(c).alias(c) for c in numeric_columns(t, among=S.FEATURES)])


# A small hand-written model: per class a tree of two cuts of scaled features, (feature, cut, value up to it,
# feature, cut, value up to it, value above), so that SQL can give every score.
_FIXED = {
    "acoustic": ("acousticness", 0.611, -0.9, "valence", -0.237, 1.1, 1.4), "alternative": ("danceability", -0.433, 0.8, "energy", 0.117, -0.2, -0.7),
    "dance": ("danceability", 0.329, -0.6, "popularity", 0.541, 0.9, 1.3), "electronic": ("energy", 0.279, -0.5, "tempo", 0.123, 0.7, 1.2),
    "heavy": ("energy", 0.913, -0.4, "liveness", -0.371, 0.35, 0.95), "vocal": ("speechiness", 0.437, -1.0, "valence", 0.251, 1.6, 0.65),
}
_FIXED_PRIOR = -1.7


def _fixed_pipeline(spark, sf) -> PipelineModel:
    names, nodes = feature_names(), []
    for c, label in enumerate(S.CLASSES):
        f, cut, low, g, second, middle, high = _FIXED[label]
        nodes += [(0, c, 0, names.index(f), cut, 1, 2, 0.0, 0.0, 0.0), (0, c, 1, -1, math.inf, -1, -1, low, 0.0, 0.0),
                  (0, c, 2, names.index(g), second, 3, 4, 0.0, 0.0, 0.0), (0, c, 3, -1, math.inf, -1, -1, middle, 0.0, 0.0),
                  (0, c, 4, -1, math.inf, -1, -1, high, 0.0, 0.0)]
    model = JointBoostingModel()
    model.prior, model.nodes, model.width = [_FIXED_PRIOR] * len(S.CLASSES), nodes, len(names)
    prepared = _prepared(spark, sf)
    return infer.bundle(prepared.preprocessor, model, models.label_decoder(prepared.labels))


def _on_fixed(sql: str, *ctes: str) -> str:
    scores = ", ".join(
        f"exp({_FIXED_PRIOR} + CASE WHEN z_{f} <= {cut} THEN {low} WHEN z_{g} <= {second} THEN {middle} ELSE {high} END) AS e_{c}"
        for c, (f, cut, low, g, second, middle, high) in _FIXED.items())
    total = "(" + " + ".join(f"e_{c}" for c in S.CLASSES) + ")"
    shares = ", ".join(f"e_{c} / {total} AS {c}" for c in S.CLASSES)
    first = "CASE " + " ".join(f"WHEN {c} = top THEN '{c}'" for c in S.CLASSES) + " END"
    return on_tracks(sql, *SCALED_SQL, f"raised AS (SELECT track_id, {scores} FROM scaled)", f"shares AS (SELECT track_id, {shares} FROM raised)",
                     f"fixed AS (SELECT *, {first} AS predicted_genre FROM (SELECT *, greatest({', '.join(S.CLASSES)}) AS top FROM shares))", *ctes)


@query(_on_fixed("SELECT track_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in S.CLASSES) + " FROM fixed"))
def fixed_tree_proba(spark, sf):
    """Probabilities of every track under the hand-written trees."""
    return rounded(infer.predict_proba(tracks(spark, sf, narrow=True), _fixed_pipeline(spark, sf), IDS), S.CLASSES)


@query(_on_fixed("SELECT track_id, predicted_genre, round(top, 6) AS top FROM fixed"))
def fixed_tree_labels(spark, sf):
    """Label of every track and its probability under the hand-written trees."""
    scored = _fixed_pipeline(spark, sf).transform(tracks(spark, sf, narrow=True))
    return scored.select("track_id", "predicted_genre", F.round(F.array_max(vector_to_array("probability")), 6).alias("top"))


@query(_on_fixed("SELECT track_id, rank, class, probability FROM (SELECT track_id, class, round(p, 6) AS probability, "
                 "CAST(row_number() OVER (PARTITION BY track_id ORDER BY p DESC, class) AS INT) AS rank FROM ("
                 + " UNION ALL ".join(f"SELECT track_id, '{c}' AS class, {c} AS p FROM fixed" for c in S.CLASSES) + ")) WHERE rank <= 3"))
def fixed_tree_ranked(spark, sf):
    """The three most probable classes of every track under the hand-written trees."""
    return rounded(infer.ranked_classes(tracks(spark, sf, narrow=True), _fixed_pipeline(spark, sf), IDS, k=3), ["probability"])


@query(_on_fixed("SELECT track_id, predicted_genre, pos, name FROM fixed JOIN playlists ON predicted_genre = genre", PLAYLISTS))
def fixed_tree_recommendations(spark, sf):
    """Playlists of every track's class under the hand-written trees."""
    scored = infer.score_batch(tracks(spark, sf, narrow=True), _fixed_pipeline(spark, sf)).select("track_id", "predicted_genre")
    return recommend.recommend_playlists(scored, "predicted_genre").select("track_id", "predicted_genre", "pos", "name")


@query(_on_fixed(
    "SELECT y_true, y_pred, coalesce(n, 0) AS n FROM (SELECT a.cls AS y_true, b.cls AS y_pred FROM classes a, classes b) "
    "LEFT JOIN (SELECT t.signal_genre AS y_true, f.predicted_genre AS y_pred, count(*) AS n FROM tracks t JOIN fixed f USING (track_id) "
    "GROUP BY ALL) USING (y_true, y_pred)", CLASSES))
def fixed_tree_confusion(spark, sf):
    """Confusion of true and predicted labels of all tracks under the hand-written trees."""
    scored = _fixed_pipeline(spark, sf).transform(tracks(spark, sf, narrow=True)).select(F.col(TARGET).alias("y_true"), F.col("predicted_genre").alias("y_pred"))
    return confusion(scored, labels=S.CLASSES)


_FIXED_USES = Counter(f for cuts in _FIXED.values() for f in (cuts[0], cuts[3]))


@query("SELECT feature, CAST(importance AS BIGINT) AS importance, original FROM ("
       + values((n, _FIXED_USES.get(n, 0), str(n in S.FEATURES).lower() == "true") for n in feature_names())
       + ") AS t(feature, importance, original)")
def fixed_tree_importance(spark, sf):
    """Splits per feature, counted over the node table of the hand-written trees."""
    return models.split_counts(spark, _fixed_pipeline(spark, sf).stages[-2])


@query("SELECT count(*) AS rows_scored, CAST(0 AS BIGINT) AS differing FROM lineitem")
def reload_equality(spark, sf):
    """A saved and reloaded pipeline scores every track as the one in memory."""
    first = _fixed_pipeline(spark, sf)
    path = scratch_dir(spark, "reloaded")
    first.write().save(path)
    inputs = [*IDS, *S.FEATURES]
    rows = tracks(spark, sf, narrow=True).select(*inputs)
    for i, p in enumerate((first, PipelineModel.load(path))):  # both beside each other on a row: nothing is joined
        before = [c for c in rows.columns if c not in inputs]
        scored = p.transform(rows.withColumns({f"_in_{c}": F.col(c) for c in inputs}))
        rows = scored.select(*[F.col(f"_in_{c}").alias(c) for c in inputs], *before, F.col("prediction").alias(f"p{i}"),
                             vector_to_array("probability").alias(f"q{i}"))
    same = F.col("p0").eqNullSafe(F.col("p1")) & F.col("q0").eqNullSafe(F.col("q1"))
    return rows.agg(F.count("*").alias("rows_scored"), F.count_if(~same).alias("differing"))


@query("SELECT count(*) AS rows_compared, CAST(0 AS BIGINT) AS differing FROM lineitem")
def preprocessor_reload(spark, sf):
    """A saved and reloaded preprocessor gives the features of the one in memory."""
    first = _prepared(spark, sf).preprocessor
    path = scratch_dir(spark, "preprocessor")
    first.write().save(path)
    rows = tracks(spark, sf, narrow=True).select(*S.FEATURES)
    rows = infer.preprocess(rows, first, keep=rows.columns).withColumn("x0", vector_to_array("features"))
    rows = infer.preprocess(rows.drop("features"), PipelineModel.load(path), keep=["x0"])  # beside each other: nothing is joined
    same = F.col("x0").eqNullSafe(vector_to_array("features"))
    return rows.agg(F.count("*").alias("rows_compared"), F.count_if(~same).alias("differing"))


@query(f"SELECT CAST(pos AS INT) AS code, cls AS label FROM ({values((c, i) for i, c in enumerate(S.CLASSES))}) AS t(cls, pos)")
def decoder_reload(spark, sf):
    """The class list of a saved and reloaded scoring pipeline, in decode order."""
    path = scratch_dir(spark, "decoder")
    _fixed_pipeline(spark, sf).write().save(path)
    return literal_table(spark, list(enumerate(infer.classes_of(PipelineModel.load(path)))), "code int, label string")


@query("SELECT section, CAST(n AS BIGINT) AS n, CAST(selected AS BIGINT) AS selected FROM "
       "(VALUES ('improvement', 3, 0), ('parameter', 1, 0), ('ranking', 30, 1)) AS t(section, n, selected)")
def selection_report_shape(spark, sf):
    """Rows per section of the selection report: five metrics of six models, one of them selected."""
    compared = _comparison(spark, sf)
    first = compared.first()
    report = training.selection_report(spark, compared, first["model"], tuning.GRID_FIXED["Random Forest"], first["mean_f1_weighted"],
                                       first["mean_f1_weighted"])
    chosen = (F.col("metric") == "selected") & (F.col("value") == "true")
    return report.groupBy("section").agg(F.count("*").alias("n"), F.count_if(chosen).alias("selected"))
