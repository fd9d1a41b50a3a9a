"""Registered queries: text to class, recommendations, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.functions.features import percent, search_url, top_gap
from tracklab.operators import cleaning as C
from tracklab.operators import metrics as E
from tracklab.operators import moodtext as M
from tracklab.operators import profile as P
from tracklab.operators import recommend as R
from tracklab.plans.oracle_views import (CLASSES, PLAYLISTS, TAGLINES, on_mapped, on_predictions, on_tracks, text,
                                         unpivot)
from tracklab.plans.registry import query, r6, rounded
from tracklab.sources.tables import predictions, probability_columns, table, tracks

PROBS = probability_columns()


def _mood_ctes(source: str, column: str = "text") -> list[str]:
    counts = ", ".join(
        "(" + " + ".join(f"CAST(contains(t, {text(k)}) AS INT)" for k in words) + f") AS n_{g}"
        for g, words in S.MOOD_KEYWORDS.items())
    total = " + ".join(f"n_{g}" for g in M.GENRES)
    best = "greatest(" + ", ".join(f"n_{g}" for g in M.GENRES) + ")"
    case = " ".join(f"WHEN n_{g} = {best} THEN '{g}'" for g in M.GENRES)
    shares = ", ".join(
        f"CASE WHEN total = 0 THEN CAST(1 AS DOUBLE) / 6 ELSE CAST(n_{g} AS DOUBLE) / total END AS share_{g}" for g in M.GENRES)
    return [
        f"lowered AS (SELECT *, lower(coalesce({column}, '')) AS t FROM {source})",
        f"hits AS (SELECT *, {counts} FROM lowered)",
        f"totals AS (SELECT *, {total} AS total FROM hits)",
        f"moods AS MATERIALIZED (SELECT * EXCLUDE (t), CASE WHEN total = 0 THEN 'dance' {case} END AS mood, {shares} FROM totals)",
    ]


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + "\n"


_SHARES = ", ".join(f"share_{g}" for g in M.GENRES)


@query(_with(*_mood_ctes("documents")) + f"SELECT doc_id, mood, {_SHARES} FROM moods")
def mood_labels(spark, sf):
    return M.mood(table(spark, sf, "documents")).select("doc_id", "mood", *[f"share_{g}" for g in M.GENRES])


@query(_with(*_mood_ctes("conversations")) + "SELECT conv_id, turn, mood, genre, share FROM ("
       + " UNION ALL ".join(f"SELECT conv_id, turn, mood, '{g}' AS genre, share_{g} AS share FROM moods" for g in M.GENRES) + ")")
def mood_scores(spark, sf):
    return M.mood_scores(table(spark, sf, "conversations"), ["conv_id", "turn"])


@query(_with(*_mood_ctes("documents")) + "SELECT lang, mood, count(*) AS n, round(avg(greatest(" + _SHARES
       + ")), 6) AS mean_share FROM moods GROUP BY lang, mood")
def mood_by_language(spark, sf):
    d = M.mood(table(spark, sf, "documents"))
    top = F.greatest(*[F.col(f"share_{g}") for g in M.GENRES])
    return d.groupBy("lang", "mood").agg(F.count("*").alias("n"), r6(F.avg(top)).alias("mean_share"))


_QUICK = "CASE CAST(conv_id % 8 AS INT) " + " ".join(f"WHEN {i} THEN {text(q)}" for i, q in enumerate(S.QUICK_MOODS)) + " END"


@query(_with(f"choices AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text ELSE '' END AS free, {_QUICK} AS quick FROM conversations)",
             "active AS (SELECT conv_id, turn, coalesce(nullif(free, ''), quick) AS text FROM choices)", *_mood_ctes("active"))
       + "SELECT conv_id, turn, mood, round(greatest(" + _SHARES + "), 6) AS share FROM moods")
def quick_mood_override(spark, sf):
    """Free text where a user wrote some, else one of the canned texts (L2)."""
    c = table(spark, sf, "conversations")
    free = F.when(F.col("role") == "user", F.col("text")).otherwise("")
    quick = F.get(F.array(*[F.lit(q) for q in S.QUICK_MOODS]), (F.col("conv_id") % 8).cast("int"))
    active = c.select("conv_id", "turn", M.active_text(free, quick).alias("text"))
    top = F.greatest(*[F.col(f"share_{g}") for g in M.GENRES])
    return M.mood(active).select("conv_id", "turn", "mood", r6(top).alias("share"))


@query(_with(PLAYLISTS, *_mood_ctes("documents"))
       + 'SELECT doc_id, mood, pos, name, "desc", url FROM moods JOIN playlists ON mood = genre')
def mood_recommendations(spark, sf):
    d = M.mood(table(spark, sf, "documents")).select("doc_id", "mood")
    return R.recommend_playlists(d, "mood").select("doc_id", "mood", "pos", "name", "desc", "url")


@query(_with(TAGLINES, *_mood_ctes("conversations")) + "SELECT conv_id, turn, mood, tagline FROM moods JOIN taglines ON mood = genre")
def mood_taglines(spark, sf):
    c = M.mood(table(spark, sf, "conversations")).select("conv_id", "turn", "mood")
    return R.with_tagline(c, "mood")


@query("SELECT p_partkey, 'https://open.spotify.com/search/' || replace(url_encode(p_name || '/' || p_brand), '%2F', '/') AS url "
       "FROM part")
def search_links(spark, sf):
    return table(spark, sf, "part").select("p_partkey", search_url(F.concat("p_name", F.lit("/"), "p_brand")).alias("url"))


def _top_sql(label: str, source: str) -> str:
    return (f"SELECT {label}, track_id, track_name, popularity, rank, 'https://open.spotify.com/track/' || track_id AS spotify_url "
            f"FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {label} ORDER BY popularity DESC, track_id) AS INT) AS rank "
            f"FROM {source} WHERE {label} IS NOT NULL) WHERE rank <= 5")


def _top(df, label):
    return R.top_tracks(df, label).select(label, "track_id", "track_name", "popularity", "rank", "spotify_url")


@query(on_tracks(_top_sql("track_genre", "tracks")))
def top_tracks_per_genre(spark, sf):
    return _top(tracks(spark, sf), "track_genre")


@query(on_mapped(_top_sql("super_genre", "mapped")))
def top_tracks_per_class(spark, sf):
    mapped = C.map_taxonomy(C.drop_null_target(tracks(spark, sf)), out="super_genre")
    return _top(mapped, "super_genre")


@query(on_predictions("SELECT track_id, y_pred, pos, name FROM predictions JOIN playlists ON y_pred = genre", PLAYLISTS))
def playlists_for_predictions(spark, sf):
    return R.recommend_playlists(predictions(spark, sf).select("track_id", "y_pred"), "y_pred").select(
        "track_id", "y_pred", "pos", "name")


_MATRIX = """matrix AS (SELECT a.cls AS y_true, b.cls AS y_pred, count(p.track_id) AS n FROM classes a CROSS JOIN classes b
 LEFT JOIN predictions p ON p.y_true = a.cls AND p.y_pred = b.cls GROUP BY a.cls, b.cls)"""
_PER_CLASS = """per_class AS (SELECT c.cls AS label, tp, support, predicted,
 CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
 CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1
 FROM (SELECT cls, (SELECT sum(n) FROM matrix WHERE y_true = cls AND y_pred = cls) AS tp,
  (SELECT sum(n) FROM matrix WHERE y_true = cls) AS support, (SELECT sum(n) FROM matrix WHERE y_pred = cls) AS predicted FROM classes) c)"""
_SUMMARY = """summary AS (SELECT sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1,
 avg(precision) AS macro_precision, avg(recall) AS macro_recall, sum(precision * support) / sum(support) AS weighted_precision,
 sum(recall * support) / sum(support) AS weighted_recall, CAST(sum(support) AS BIGINT) AS n FROM per_class)"""
_EVAL = [CLASSES, _MATRIX, _PER_CLASS, _SUMMARY]


def _matrix(spark, sf):
    return E.confusion(predictions(spark, sf))


@query(on_predictions("SELECT * FROM matrix", *_EVAL))
def confusion(spark, sf):
    return _matrix(spark, sf)


@query(on_predictions("SELECT y_true, y_pred, round(n / sum(n) OVER (PARTITION BY y_true), 6) AS share FROM matrix", *_EVAL))
def confusion_norm(spark, sf):
    return rounded(E.confusion_shares(_matrix(spark, sf)), ["share"])


@query(on_predictions("""SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per_class
 UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), n FROM summary
 UNION ALL SELECT 'macro avg', round(macro_precision, 6), round(macro_recall, 6), round(macro_f1, 6), n FROM summary
 UNION ALL SELECT 'weighted avg', round(weighted_precision, 6), round(weighted_recall, 6), round(weighted_f1, 6), n FROM summary""", *_EVAL))
def classification_report(spark, sf):
    return rounded(E.classification_report(_matrix(spark, sf)), ["precision", "recall", "f1"])


_AUC = [
    f"long AS ({unpivot('predictions', PROBS.values(), 'y_true', 'col', 'score')})",
    "scores AS (SELECT substr(col, 3) AS class, score, CAST(y_true = substr(col, 3) AS INT) AS y FROM long)",
    """ranked AS (SELECT class, y, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2 AS r
 FROM scores)""",
    """aucs AS (SELECT class, (sum(r) FILTER (WHERE y = 1) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2) / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))) AS auc
 FROM ranked GROUP BY class)""",
]


def _aucs(spark, sf):
    return E.auc_per_class(predictions(spark, sf, busy=True), PROBS)


@query(on_predictions("""SELECT round(accuracy, 6) AS accuracy, round(weighted_f1, 6) AS weighted_f1, round(macro_f1, 6) AS macro_f1,
 accuracy >= 0.8 AS target_met, CASE WHEN accuracy < 0.8 THEN round(0.8 - accuracy, 6) END AS gap,
 (SELECT round(avg(auc), 6) FROM aucs) AS macro_auc FROM summary""", *_EVAL, *_AUC))
def metric_summary(spark, sf):
    row = E.metrics_with_auc(_matrix(spark, sf), _aucs(spark, sf), S.CLASSES)
    return rounded(row, ["accuracy", "weighted_f1", "macro_f1", "gap", "macro_auc"])


@query(on_predictions("""SELECT metric, round(value, 6) AS value FROM (SELECT 'accuracy' AS metric, accuracy AS value FROM summary
 UNION ALL SELECT 'weighted_f1', weighted_f1 FROM summary UNION ALL SELECT 'macro_f1', macro_f1 FROM summary
 UNION ALL SELECT 'macro_auc', (SELECT avg(auc) FROM aucs))""", *_EVAL, *_AUC))
def metric_table(spark, sf):
    macro = E.macro_auc(_aucs(spark, sf), S.CLASSES).first()["macro_auc"]
    return rounded(E.metric_table(_matrix(spark, sf), macro), ["value"])


@query(on_predictions("""SELECT round(accuracy, 6) AS accuracy, round(0.8 - accuracy, 6) AS gap, attempt
 FROM summary, (VALUES ('six classes'), ('feature set doubled')) a(attempt) WHERE accuracy < 0.8""", *_EVAL))
def improvement_gap(spark, sf):
    log = E.improvement_log(_matrix(spark, sf), ["six classes", "feature set doubled"])
    return rounded(log, ["accuracy", "gap"])


@query(on_predictions("""SELECT t.y_true, CAST(correct AS BIGINT) AS correct, CAST(total AS BIGINT) AS total, round(correct / total, 6) AS recall, e.y_pred AS confused_with, e.n AS confused_n
 FROM (SELECT y_true, sum(n) FILTER (WHERE y_true = y_pred) AS correct, sum(n) AS total FROM matrix GROUP BY y_true) t
 LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY y_true ORDER BY n DESC, y_pred) AS r FROM matrix WHERE y_true <> y_pred AND n > 0) e
 ON t.y_true = e.y_true AND r = 1""", *_EVAL))
def main_confusion(spark, sf):
    return rounded(E.main_confusion(_matrix(spark, sf)), ["recall"])


@query(on_predictions("""SELECT class, score AS threshold,
 round(sum(neg) OVER w / sum(neg) OVER (PARTITION BY class), 6) AS fpr, round(sum(pos) OVER w / sum(pos) OVER (PARTITION BY class), 6) AS tpr
 FROM (SELECT class, score, sum(y) AS pos, count(*) - sum(y) AS neg FROM scores GROUP BY class, score)
 WINDOW w AS (PARTITION BY class ORDER BY score DESC)
 UNION ALL SELECT DISTINCT class, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM scores""", *_AUC))
def roc_points(spark, sf):
    return rounded(E.roc_points(predictions(spark, sf, busy=True), PROBS), ["fpr", "tpr"])


@query(on_predictions("SELECT class, round(auc, 6) AS auc FROM aucs", *_AUC))
def auc_per_class(spark, sf):
    return rounded(_aucs(spark, sf), ["auc"])


@query(on_predictions("SELECT class, round(auc, 6) AS auc FROM aucs", *_AUC))
def auc_per_class_ranged(spark, sf):
    """The same areas by the path for classes too large to sort in one task."""
    aucs = E.auc_per_class(predictions(spark, sf, busy=True), PROBS, plain_rows=0)
    return rounded(aucs, ["auc"])


@query(on_predictions("SELECT round(avg(auc), 6) AS macro_auc FROM aucs", *_AUC))
def macro_auc(spark, sf):
    return rounded(E.macro_auc(_aucs(spark, sf), S.CLASSES), ["macro_auc"])


@query(on_predictions("SELECT class, sum(y) AS positives, count(*) AS n FROM (SELECT class, CAST(y AS BIGINT) AS y FROM scores) GROUP BY class", *_AUC).replace(
    "sum(y) AS positives", "CAST(sum(y) AS BIGINT) AS positives"))
def one_hot_labels(spark, sf):
    rows = E.class_scores(predictions(spark, sf), PROBS)
    return rows.groupBy("class").agg(F.sum("y").alias("positives"), F.count("*").alias("n"))


@query(on_predictions("""SELECT track_id, rank, class, probability FROM (SELECT track_id, substr(col, 3) AS class, score AS probability,
 CAST(row_number() OVER (PARTITION BY track_id ORDER BY score DESC, col) AS INT) AS rank FROM long) WHERE rank <= 5""",
                      f"long AS ({unpivot('predictions', PROBS.values(), 'track_id', 'col', 'score')})"))
def topk_classes(spark, sf):
    return R.top_classes(predictions(spark, sf), PROBS, ["track_id"])


@query(on_predictions("SELECT track_id, y_pred, round_even(top1 * 100, 1) AS confidence FROM predictions"))
def confidence(spark, sf):
    return predictions(spark, sf).select("track_id", "y_pred", percent(F.col("top1")).alias("confidence"))


_GAPS = """gaps AS (SELECT y_true, y_true = y_pred AS hit, top1, top1 - list_extract(list_reverse_sort(
 [p_acoustic, p_alternative, p_dance, p_electronic, p_heavy, p_vocal]), 2) AS gap FROM predictions)"""


@query(on_predictions("""SELECT round(avg(gap), 6) AS mean_gap, round(avg(gap) FILTER (WHERE hit), 6) AS mean_gap_correct,
 round(avg(gap) FILTER (WHERE NOT hit), 6) AS mean_gap_incorrect, round(quantile_cont(top1, 0.5), 6) AS median_top1 FROM gaps""", _GAPS))
def confidence_gap(spark, sf):
    row = E.confidence_gap(predictions(spark, sf, busy=True), list(PROBS.values()))
    return rounded(row, row.columns)


_BOX = """boxes AS (SELECT y_true, quantile_cont(top1, 0.25) AS q1, quantile_cont(top1, 0.5) AS median, quantile_cont(top1, 0.75) AS q3
 FROM predictions GROUP BY y_true)"""


@query(on_predictions("""SELECT y_true, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
 round(min(top1) FILTER (WHERE inside), 6) AS low_whisker, round(max(top1) FILTER (WHERE inside), 6) AS high_whisker,
 count(*) FILTER (WHERE NOT inside) AS n_outliers
 FROM (SELECT p.y_true, top1, q1, median, q3, top1 BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
  FROM predictions p JOIN boxes b ON p.y_true = b.y_true) GROUP BY y_true, boxes.q1, median, q3""".replace("boxes.q1", "q1"), _BOX))
def top1_boxplot(spark, sf):
    box = P.boxplot(predictions(spark, sf, busy=True), "top1", "y_true")
    return rounded(box, ["q1", "median", "q3", "low_whisker", "high_whisker"])


@query(on_predictions("""SELECT hit, CAST(bin AS INT) AS bin, n FROM (SELECT l.hit, b.i AS bin, coalesce(c.n, 0) AS n FROM lim l CROSS JOIN range(50) b(i) LEFT JOIN
 (SELECT g.hit, least(floor((gap - low) / width), 49) AS bin, count(*) AS n FROM gaps g JOIN lim ON g.hit = lim.hit GROUP BY ALL) c
 ON c.hit = l.hit AND c.bin = b.i)""", _GAPS,
                      "lim AS (SELECT hit, min(gap) AS low, (max(gap) - min(gap)) / 50 AS width FROM gaps GROUP BY hit)"))
def gap_histogram(spark, sf):
    p = predictions(spark, sf, busy=True)
    gaps = p.select((F.col("y_true") == F.col("y_pred")).alias("hit"), top_gap(F.array(*PROBS.values())).alias("gap"))
    return P.histogram(gaps, ["gap"], bins=50, by=["hit"]).select("hit", "bin", "n")
