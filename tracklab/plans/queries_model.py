"""Registered queries: features, scaling, splits, mutual information, neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.functions.features import engineer, feature_names
from tracklab.operators import cleaning as C
from tracklab.operators import metrics as E
from tracklab.operators import mutual_info as I
from tracklab.operators import profile as P
from tracklab.operators import split as X
from tracklab.operators.knn import knn_vote as vote
from tracklab.operators.stages import preprocessor, scaled_names
from tracklab.plans import eda
from tracklab.plans.oracle_views import MAPPED, TAXONOMY, on_tracks, unpivot
from tracklab.plans.registry import query, r6, rounded
from tracklab.session import scratch_dir
from tracklab.sources import files
from tracklab.sources.staging import stage
from tracklab.sources.tables import table, tracks

# Expressions of the derived features, for the oracle.
FEATURE_SQL = {
    **{c: f"CAST({c} AS DOUBLE)" for c in S.FEATURES},
    **{f"log1p_{c}": f"ln(1 + greatest({c}, 0))"
       for c in ("speechiness", "acousticness", "instrumentalness", "liveness")},
    "duration_min": "duration_ms / CAST(60000 AS DOUBLE)",
    "log_duration_ms": "ln(1 + greatest(CAST(duration_ms AS DOUBLE), 0))",
    "abs_loudness": "abs(loudness)",
    "loudness_norm": "abs(loudness) / 60",
    "energy_x_not_acoustic": "energy * (1 - acousticness)",
    "dance_x_energy": "danceability * energy",
    "valence_x_energy": "valence * energy",
    "valence_x_dance": "valence * danceability",
    "speech_x_not_acoustic": "speechiness * (1 - acousticness)",
    "instrumental_x_energy": "instrumentalness * energy",
    "loudness_per_energy": "abs(loudness) / (energy + CAST(0.000001 AS DOUBLE))",
    "pop_x_dance": "(popularity / CAST(100 AS DOUBLE)) * danceability",
    "acoustic_x_valence": "acousticness * valence",
    "tempo_sq": "(tempo / 250) * (tempo / 250)",
    "popularity_sq": "(popularity / CAST(100 AS DOUBLE)) * (popularity / CAST(100 AS DOUBLE))",
    "energy_sq": "energy * energy",
    "acousticness_sq": "acousticness * acousticness",
    "instrumentalness_sq": "instrumentalness * instrumentalness",
    "tempo_norm": "tempo / 250",
    "tempo_slow": "CASE WHEN tempo < 90 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "tempo_fast": "CASE WHEN tempo > 140 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "key_x_mode": "CAST(key * mode AS DOUBLE)",
    "liveness_ratio": "liveness / (energy + CAST(0.000001 AS DOUBLE))",
}
_LOGS = [c for c in FEATURE_SQL if c.startswith("log")]


def _feature_select(extra: str, names=None) -> str:
    return f"SELECT {extra}, " + ", ".join(f"{FEATURE_SQL[c]} AS {c}" for c in names or FEATURE_SQL)


@query(on_tracks("SELECT track_id, " + ", ".join(f"round({c}, 6) AS {c}" if c in _LOGS else c for c in FEATURE_SQL)
                 + " FROM (" + _feature_select("track_id") + " FROM tracks)"))
def engineered_features(spark, sf):
    return rounded(engineer(tracks(spark, sf), keep=["track_id"]), _LOGS)


# Hash order of each class, and the seats of every class in the two split steps.
def _ranked_sql(label: str = "signal_genre") -> str:
    return (f"ranked AS (SELECT *, {label} AS label, row_number() OVER (PARTITION BY {label} "
            f"ORDER BY md5(concat_ws('|', track_id, '42'))) AS rn FROM tracks WHERE {label} IS NOT NULL)")


def _seats_sql(name: str, source: str, seats: str, n: str) -> str:
    """Largest-remainder seats per label: floor first, spare seats by remainder, then label."""
    return f"""{name} AS (SELECT label, {n} AS n, CAST(fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= spare THEN 1 ELSE 0 END AS BIGINT) AS seats
 FROM (SELECT *, seats - sum(fl) OVER () AS spare FROM (SELECT label, {n}, seats, (seats * {n}) // total AS fl, (seats * {n}) % total AS rem
  FROM (SELECT label, {n}, CAST(sum({n}) OVER () AS BIGINT) AS total, CAST({seats} AS BIGINT) AS seats FROM {source}))))"""


_SPLIT = [
    _ranked_sql(),
    "sizes AS (SELECT label, count(*) AS n FROM ranked GROUP BY label)",
    _seats_sql("test_seats", "sizes", "ceil(CAST(0.15 AS DOUBLE) * sum(n) OVER ())", "n"),
    "rest AS (SELECT label, n - seats AS n FROM test_seats)",
    _seats_sql("val_seats", "rest", "ceil(CAST(0.15 AS DOUBLE) / (1 - CAST(0.15 AS DOUBLE)) * sum(n) OVER ())", "n"),
    """split AS (SELECT r.*, CASE WHEN rn <= t.seats THEN 'test' WHEN rn <= t.seats + v.seats THEN 'val' ELSE 'train' END AS split
 FROM ranked r JOIN test_seats t ON r.label = t.label JOIN val_seats v ON r.label = v.label)""",
]


def _split(spark, sf):
    return X.stratified_split(tracks(spark, sf, busy=True), "signal_genre", ["track_id"])


@query(on_tracks("SELECT track_id, signal_genre, split FROM split", *_SPLIT))
def stratified_split(spark, sf):
    return _split(spark, sf).select("track_id", "signal_genre", "split")


_SHARES = "shares AS (SELECT split, label AS class, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY split) AS share FROM split GROUP BY split, label)"


@query(on_tracks("SELECT split, class, n, round(share, 6) AS share FROM shares", *_SPLIT, _SHARES))
def split_proportions(spark, sf):
    return rounded(E.class_shares(_split(spark, sf), "signal_genre"), ["share"])


@query(on_tracks("""SELECT a.class, round(a.share, 6) AS train_share, round(b.share, 6) AS test_share, round(abs(a.share - b.share), 6) AS drift,
 abs(a.share - b.share) <= 0.03 AS within FROM shares a JOIN shares b ON a.class = b.class AND a.split = 'train' AND b.split = 'test'""",
                 *_SPLIT, _SHARES))
def split_drift(spark, sf):
    return rounded(E.share_drift(_split(spark, sf), "signal_genre"), ["train_share", "test_share", "drift"])


@query(on_tracks("SELECT split, count(*) AS n, count(DISTINCT label) AS n_classes FROM split GROUP BY split", *_SPLIT))
def split_reload(spark, sf):
    """Splits written by folder and read back one by one."""
    path = scratch_dir(spark, "splits")
    files.write_splits(_split(spark, sf).select("track_id", "signal_genre", "split"), path)
    parts = [files.read_split(spark, path, [s]) for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("split").agg(
        F.count("*").alias("n"), F.countDistinct("signal_genre").alias("n_classes"))


@query(on_tracks("SELECT label AS signal_genre, count(*) AS n FROM split WHERE split IN ('train', 'val') GROUP BY label", *_SPLIT))
def trainval_union(spark, sf):
    rows = _split(spark, sf).select("signal_genre", "split")
    both = rows.filter("split = 'train'").unionByName(rows.filter("split = 'val'"))
    return both.groupBy("signal_genre").agg(F.count("*").alias("n"))


_SAMPLE_SEATS = _seats_sql("seats", "sizes", "2000", "n")
_SAMPLE = [_ranked_sql(), "sizes AS (SELECT label, count(*) AS n FROM ranked GROUP BY label)", _SAMPLE_SEATS]


@query(on_tracks("SELECT track_id, signal_genre FROM ranked r JOIN seats s ON r.label = s.label AND rn <= seats", *_SAMPLE))
def stratified_sample(spark, sf):
    t = tracks(spark, sf, busy=True).select("track_id", "signal_genre")
    return X.stratified_sample(t, "signal_genre", ["track_id"], 2000)


@query(on_tracks("""SELECT track_id, signal_genre, CAST(CASE WHEN rn <= s0 THEN 0 WHEN rn <= s0 + s1 THEN 1 ELSE 2 END AS INT) AS fold
 FROM ranked r JOIN (SELECT label, n // 3 + CASE WHEN (0 - off + 300) % 3 < n % 3 THEN 1 ELSE 0 END AS s0,
  n // 3 + CASE WHEN (1 - off + 300) % 3 < n % 3 THEN 1 ELSE 0 END AS s1
  FROM (SELECT label, count(*) AS n, row_number() OVER (ORDER BY label) - 1 AS off FROM ranked GROUP BY label)) f ON r.label = f.label""",
                 _ranked_sql()))
def kfold_assign(spark, sf):
    t = tracks(spark, sf, busy=True).select("track_id", "signal_genre")
    return X.stratified_folds(t, "signal_genre", ["track_id"], 3)


_SCALED = [
    *_SPLIT,
    "feats AS MATERIALIZED (" + _feature_select("track_id, split") + " FROM split)",
    "moments AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in FEATURE_SQL)
    + " FROM feats WHERE split = 'train')",
    "scaled AS MATERIALIZED (SELECT track_id, split, " + ", ".join(
        f"({c} - m_{c}) / s_{c} AS z_{c}" for c in FEATURE_SQL) + " FROM feats, moments)",
]


def _scaled(spark, sf):
    split = stage(_split(spark, sf), "split-rows")
    fitted = preprocessor().fit(split.filter("split = 'train'"))
    return fitted.transform(split)


@query(on_tracks("SELECT track_id, split, " + ", ".join(f"round(z_{c}, 6) AS z_{c}" for c in FEATURE_SQL)
                 + " FROM scaled", *_SCALED))
def scaled_features(spark, sf):
    z = _scaled(spark, sf).select("track_id", "split", *scaled_names())
    return rounded(z, scaled_names())


@query(on_tracks(" UNION ALL ".join(
    f"SELECT 'z_{c}' AS feature, round(avg(z_{c}), 4 + 2) AS mean, round(stddev_pop(z_{c}), 6) AS std, "
    f"round(min(z_{c}), 6) AS min, round(max(z_{c}), 6) AS max FROM scaled WHERE split = 'train'"
    for c in FEATURE_SQL), *_SCALED))
def scaled_stats(spark, sf):
    z = _scaled(spark, sf).filter("split = 'train'").select(*scaled_names())
    stats = P.moments(z, scaled_names())
    population = F.col("std") * F.sqrt((F.col("count") - 1) / F.col("count"))
    return stats.select("feature", r6(F.col("mean")).alias("mean"), r6(population).alias("std"),
                        r6(F.col("min")).alias("min"), r6(F.col("max")).alias("max"))


_DISCRETE = [*S.DISCRETE_FEATURES, "popularity"]


def _mi_sql(rows: str) -> list[str]:
    return [
        f"cells AS ({rows})",
        "joint AS (SELECT feature, value, cls, count(*) AS xy FROM cells WHERE value IS NOT NULL AND cls IS NOT NULL GROUP BY ALL)",
        """scores AS (SELECT feature, sum(xy / n * ln(xy * n / (x * y))) AS mi FROM (SELECT feature, CAST(xy AS DOUBLE) AS xy,
 CAST(sum(xy) OVER (PARTITION BY feature) AS DOUBLE) AS n, CAST(sum(xy) OVER (PARTITION BY feature, value) AS DOUBLE) AS x,
 CAST(sum(xy) OVER (PARTITION BY feature, cls) AS DOUBLE) AS y FROM joint) GROUP BY feature)""",
    ]


_MI_OUT = "SELECT feature, round(mi, 6) AS mutual_info FROM scores"


@query(on_tracks(_MI_OUT, *_mi_sql(unpivot("tracks", _DISCRETE, "signal_genre AS cls"))))
def mi_discrete(spark, sf):
    t = C.cast_bool(tracks(spark, sf, busy=True))
    return rounded(I.discrete_mi(t, _DISCRETE, "signal_genre"), ["mutual_info"])


_CONTINUOUS = [c for c in S.FEATURES if c not in S.DISCRETE_FEATURES]
_EDGES = "edges AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, unnest(quantile_cont(CAST({c} AS DOUBLE), [{', '.join(str(i / 16) for i in range(1, 16))}])) AS edge FROM tracks"
    for c in _CONTINUOUS) + ")"


@query(on_tracks(_MI_OUT, _EDGES, *_mi_sql(
    "SELECT l.feature, l.cls, CAST(list_count(list_filter(e.edges, lambda q: q <= l.value)) AS DOUBLE) AS value FROM ("
    + unpivot("tracks", _CONTINUOUS, "signal_genre AS cls")
    + ") l JOIN (SELECT feature, list(edge) AS edges FROM edges GROUP BY feature) e ON l.feature = e.feature")))
def mi_binned(spark, sf):
    return rounded(I.binned_mi(tracks(spark, sf, busy=True), _CONTINUOUS, "signal_genre"), ["mutual_info"])


def _digamma_sql(n: str) -> str:
    small = [-I.EULER_GAMMA]
    for i in range(1, 10):
        small.append(small[-1] + 1.0 / i)
    listed = ", ".join(f"CAST({v!r} AS DOUBLE)" for v in small)
    x = f"CAST({n} AS DOUBLE)"
    return (f"(CASE WHEN {n} <= 10 THEN list_extract([{listed}], CAST({n} AS INT)) ELSE ln({x}) - 1 / (2 * {x}) - 1 / (12 * {x} * {x}) "
            f"+ 1 / (120 * {x} * {x} * {x} * {x}) - 1 / (252 * {x} * {x} * {x} * {x} * {x} * {x}) END)")


def _knn_mi_sql(rows: str) -> list[str]:
    """One-dimensional nearest-neighbour estimate with plain windows."""
    w = "(PARTITION BY feature, cls ORDER BY value)"
    gaps = ", ".join(f"value - lag(value, {i}) OVER {w}, lead(value, {i}) OVER {w} - value" for i in (1, 2, 3))
    return [
        f"cells AS ({rows})",
        """pts AS (SELECT *, least(3, nc - 1) AS k FROM (SELECT *, count(*) OVER (PARTITION BY feature, cls) AS nc
 FROM cells WHERE value IS NOT NULL AND cls IS NOT NULL) WHERE nc > 1)""",
        f"""radii AS MATERIALIZED (SELECT feature, cls, value, nc, k,
 list_extract(list_sort(list_filter([{gaps}], lambda g: g IS NOT NULL)), k) AS d FROM pts)""",
        "vals AS (SELECT feature, value, count(*) AS c FROM pts GROUP BY feature, value)",
        "cum AS MATERIALIZED (SELECT feature, value, c, sum(c) OVER (PARTITION BY feature ORDER BY value) AS upto FROM vals)",
        "places AS (SELECT DISTINCT feature, cls, value, d FROM radii)",
        # The values around a rounded end are tested by their distance itself.
        """edges AS MATERIALIZED (SELECT feature, value, upto,
 [lag(value, 2) OVER w, lag(value) OVER w, value, lead(value) OVER w, lead(value, 2) OVER w] AS vs,
 [lag(upto, 2) OVER w, lag(upto) OVER w, upto, lead(upto) OVER w, lead(upto, 2) OVER w] AS us,
 [lag(upto - c, 2) OVER w, lag(upto - c) OVER w, upto - c, lead(upto - c) OVER w, lead(upto - c, 2) OVER w] AS bs
 FROM cum WINDOW w AS (PARTITION BY feature ORDER BY value))""",
        """hi AS (SELECT p.feature, p.cls, p.value, p.d,
 list_max(list_transform(range(1, 6), lambda i: CASE WHEN vs[i] - p.value < p.d OR vs[i] = p.value THEN us[i] END)) AS n
 FROM places p ASOF JOIN edges c ON p.feature = c.feature AND p.value + p.d >= c.value)""",
        """lo AS (SELECT p.feature, p.cls, p.value,
 list_min(list_transform(range(1, 6), lambda i: CASE WHEN p.value - vs[i] < p.d OR vs[i] = p.value THEN bs[i] END)) AS n
 FROM places p ASOF JOIN edges c ON p.feature = c.feature AND p.value - p.d <= c.value)""",
        "inside AS (SELECT hi.feature, hi.cls, hi.value, hi.n - lo.n AS m FROM hi JOIN lo USING (feature, cls, value))",
        f"""scores AS (SELECT feature, greatest({_digamma_sql('count(*)')} + avg({_digamma_sql('k')}) - avg({_digamma_sql('nc')})
 - avg({_digamma_sql('m')}), 0) AS mi FROM radii JOIN inside USING (feature, cls, value) GROUP BY feature)""",
    ]


@query(on_tracks(_MI_OUT, *_knn_mi_sql(unpivot("tracks", _CONTINUOUS, "signal_genre AS cls"))))
def mi_knn(spark, sf):
    return rounded(I.knn_mi(tracks(spark, sf, busy=True), _CONTINUOUS, "signal_genre"), ["mutual_info"])


@query("WITH " + ", ".join(_knn_mi_sql(unpivot("events", ["value"], "event_type AS cls"))) + "\n" + _MI_OUT)
def mi_knn_events(spark, sf):
    return rounded(I.knn_mi(table(spark, sf, "events"), ["value"], "event_type"), ["mutual_info"])


@query(on_tracks(_MI_OUT, *_knn_mi_sql(unpivot("tracks", ["loudness", "valence"], "signal_genre AS cls"))))
def mi_knn_ranged(spark, sf):
    """The same estimate by the path for features too large to sort in one task."""
    scores = I.knn_mi(tracks(spark, sf, busy=True), ["loudness", "valence"], "signal_genre", plain_rows=0)
    return rounded(scores, ["mutual_info"])


@query(on_tracks(_MI_OUT, *_knn_mi_sql(unpivot("tracks", _CONTINUOUS, "signal_genre AS cls"))))
def mi_knn_ranged_all(spark, sf):
    """All continuous features by the path for large groups."""
    return rounded(I.knn_mi(tracks(spark, sf, busy=True), _CONTINUOUS, "signal_genre", plain_rows=0), ["mutual_info"])


_CLASS_SAMPLE = """picked AS (SELECT track_genre FROM (SELECT DISTINCT track_genre FROM tracks WHERE track_genre IS NOT NULL)
 ORDER BY md5(concat_ws('|', track_genre, '42')), track_genre LIMIT 10)"""


@query(on_tracks("SELECT track_genre FROM picked", _CLASS_SAMPLE))
def class_sample(spark, sf):
    return X.sampled_classes(tracks(spark, sf), "track_genre", 10)


@query(on_tracks("SELECT loudness, energy, speechiness, acousticness, track_genre FROM tracks WHERE track_genre IN (SELECT track_genre FROM picked)",
                 _CLASS_SAMPLE))
def pairplot_rows(spark, sf):
    t = tracks(spark, sf, busy=True)
    scores = I.binned_mi(t, ["loudness", "energy", "speechiness", "acousticness", "valence"], "signal_genre")
    return eda.pairplot_rows(t, "track_genre", scores)


_KNN = """pairs AS (SELECT q.vec_id AS id, t.vec_id AS other, t.label, list_sum(list_transform(range(1, len(q.embedding) + 1),
 lambda i: (CAST(q.embedding[i] AS DOUBLE) - t.embedding[i]) * (CAST(q.embedding[i] AS DOUBLE) - t.embedding[i]))) AS d
 FROM embeddings q JOIN embeddings t ON q.vec_id <> t.vec_id),
near AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS rn FROM pairs),
votes AS (SELECT id, label, count(*) AS n FROM near WHERE rn <= 7 GROUP BY id, label)"""


@query("WITH " + _KNN + """ SELECT id, CAST(label AS DOUBLE) AS prediction FROM (SELECT *, row_number() OVER
 (PARTITION BY id ORDER BY n DESC, label) AS r FROM votes) WHERE r = 1""")
def knn_vote(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), "label")
    return vote(rows.select("id", "x"), rows, 7, leave_one_out=True)


@query("WITH " + _KNN + """ SELECT id, CAST(label AS DOUBLE) AS prediction FROM (SELECT *, row_number() OVER
 (PARTITION BY id ORDER BY n DESC, label) AS r FROM votes) WHERE r = 1""")
def knn_vote_blocks(spark, sf):
    """The same votes by the path for training sides too large to broadcast."""
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), "label")
    return vote(rows.select("id", "x"), rows, 7, leave_one_out=True, broadcast_cells=1, block_rows=200)


_SUMMARY_STATS = " UNION ALL ".join(
    f"SELECT 'statistics' AS section, '{c}' AS key, '{m}' AS metric, {e.format(c=f'CAST({c} AS DOUBLE)')} AS value FROM mapped"
    for c in S.FEATURES if c != "explicit"
    for m, e in (("mean", "avg({c})"), ("std", "stddev_samp({c})"), ("min", "min({c})"), ("max", "max({c})"),
                 ("skew", "skewness({c})"), ("kurtosis", "kurtosis({c})")))
_SUMMARY_COLUMNS = ["track_id", "track_name", *S.FEATURES, "super_genre"]


_SUMMARY_SQL = (
    "SELECT section, key, metric, round(value, 6) AS value FROM (" + " UNION ALL ".join([
        "SELECT 'overview' AS section, 'table' AS key, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM mapped",
        f"SELECT 'overview', 'table', 'columns', CAST({len(_SUMMARY_COLUMNS)} AS DOUBLE)",
        "SELECT 'overview', 'table', 'missing', CAST(0 AS DOUBLE)",
        "SELECT 'overview', 'table', 'n_classes', CAST(count(*) AS DOUBLE) FROM counts",
        "SELECT 'overview', 'table', 'min_count', CAST(min(n) AS DOUBLE) FROM counts",
        "SELECT 'overview', 'table', 'max_count', CAST(max(n) AS DOUBLE) FROM counts",
        "SELECT 'overview', 'table', 'balanced', CASE WHEN (max(n) - min(n)) / max(n) < 0.05 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END FROM counts",
        "SELECT 'target', super_genre, 'count', CAST(n AS DOUBLE) FROM counts",
        "SELECT 'target', super_genre, 'percentage', round_even(n / (SELECT count(*) FROM mapped) * 100, 2) FROM counts",
        _SUMMARY_STATS,
        "SELECT 'importance', feature, 'mutual_info', mi FROM scores",
    ]) + ")", TAXONOMY, MAPPED, "counts AS (SELECT super_genre, count(*) AS n FROM mapped GROUP BY super_genre)")


@query(on_tracks(*_SUMMARY_SQL, *_mi_sql(unpivot("mapped", ["key", "mode"], "super_genre AS cls"))))
def eda_summary(spark, sf):
    mapped = C.map_taxonomy(C.drop_null_target(tracks(spark, sf, busy=True)), out="super_genre")
    rows = mapped.select(*_SUMMARY_COLUMNS)
    scores = I.discrete_mi(rows, ["key", "mode"], "super_genre")
    return rounded(eda.eda_summary(rows, "super_genre", scores), ["value"])


_NUMERIC = [c for c in S.FEATURES if c != "explicit"]


@query(on_tracks(*_SUMMARY_SQL, *_knn_mi_sql(" UNION ALL ".join(
    f"SELECT super_genre AS cls, '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), 0) AS value FROM mapped" for c in _NUMERIC))))
def eda_summary_knn(spark, sf):
    """The report with the operator's own scores: the neighbour estimate of all numeric features, missing cells as 0."""
    mapped = C.map_taxonomy(C.drop_null_target(tracks(spark, sf, busy=True)), out="super_genre")
    return rounded(eda.eda_summary(mapped.select(*_SUMMARY_COLUMNS), "super_genre"), ["value"])
