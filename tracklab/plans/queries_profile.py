"""Registered queries: scans, cleaning, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators import cleaning as C
from tracklab.operators import ordered as O
from tracklab.operators import profile as P
from tracklab.operators.small import melt
from tracklab.plans.oracle_views import on_mapped, on_tracks, per_column, unpivot
from tracklab.plans.registry import query, rounded
from tracklab.sources import files
from tracklab.session import scratch_dir
from tracklab.sources.tables import table, tracks

NUMERIC = [c for c in S.FEATURES if c != "explicit"]
TRACK_COLUMNS = [
    "gid", "track_id", "artist_key", "track_name", *S.FEATURES, "track_genre", "signal_genre",
]


def _counts_sql(source: str, column: str) -> str:
    return (
        f"SELECT {column} AS label, count(*) AS count, "
        f"round_even(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {source}) * 100, 2) AS percentage "
        f"FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"
    )


@query(on_tracks(_counts_sql("tracks", "track_genre")))
def target_summary(spark, sf):
    return P.value_counts(tracks(spark, sf), "track_genre")


@query(on_mapped(_counts_sql("mapped", "super_genre")))
def super_genre_counts(spark, sf):
    mapped = C.map_taxonomy(C.drop_null_target(tracks(spark, sf)), out="super_genre")
    return P.value_counts(mapped, "super_genre")


@query(_counts_sql("events", "event_type"))
def event_type_counts(spark, sf):
    return P.value_counts(table(spark, sf, "events"), "event_type")


@query(on_tracks("""SELECT count(*) AS n_classes, min(n) AS min_count, max(n) AS max_count, avg(n) AS mean_count,
 (max(n) - min(n)) / max(n) < 0.05 AS balanced
 FROM (SELECT count(*) AS n FROM tracks WHERE track_genre IS NOT NULL GROUP BY track_genre)"""))
def class_balance(spark, sf):
    return P.class_balance(tracks(spark, sf), "track_genre")


@query(on_tracks(
    "SELECT count(*) AS n_rows, count(track_genre) AS n_kept, count(*) - count(track_genre) AS n_dropped FROM tracks"))
def null_target_rows(spark, sf):
    t = tracks(spark, sf)
    return t.agg(F.count("*").alias("n_rows"), F.count("track_genre").alias("n_kept"),
                 F.count_if(F.col("track_genre").isNull()).alias("n_dropped"))


@query(on_mapped("SELECT DISTINCT track_genre AS raw_label FROM mapped WHERE track_genre NOT IN (SELECT raw FROM taxonomy)"))
def unmapped_labels(spark, sf):
    return C.unmapped_labels(tracks(spark, sf))


@query(on_mapped("SELECT DISTINCT super_genre FROM mapped"))
def class_list(spark, sf):
    mapped = C.map_taxonomy(C.drop_null_target(tracks(spark, sf)), out="super_genre")
    return mapped.select("super_genre").distinct().orderBy("super_genre")


@query(on_tracks("""SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INT) AS code
 FROM (SELECT DISTINCT track_genre AS label FROM tracks WHERE track_genre IS NOT NULL)"""))
def label_codes(spark, sf):
    return C.label_codes(tracks(spark, sf), "track_genre")


@query(on_mapped("""SELECT c.code, count(*) AS n, min(super_genre) AS label FROM mapped JOIN
 (SELECT l, CAST(row_number() OVER (ORDER BY l) - 1 AS INT) AS code FROM (SELECT DISTINCT super_genre AS l FROM mapped)) c
 ON super_genre = c.l GROUP BY c.code"""))
def encoded_targets(spark, sf):
    mapped = C.map_taxonomy(C.drop_null_target(tracks(spark, sf)), out="super_genre")
    coded = C.encode_labels(mapped, "super_genre")
    return coded.groupBy("code").agg(F.count("*").alias("n"), F.min("super_genre").alias("label"))


@query(on_tracks(" UNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS \"column\", CASE max(typeof({c})) WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
    f"ELSE lower(max(typeof({c}))) END AS dtype, {c not in ('track_id', 'signal_genre')} AS nullable, count(*) AS n_rows FROM tracks"
    for i, c in enumerate(TRACK_COLUMNS))))
def schema_report(spark, sf):
    t = tracks(spark, sf).select(*TRACK_COLUMNS)
    return P.schema_report(t)


@query(on_tracks("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
    f"round_even((count(*) - count({c})) / count(*) * 100, 4) AS missing_pct FROM tracks"
    for c in TRACK_COLUMNS) + ") WHERE missing_count > 0"))
def missing_counts(spark, sf):
    return P.missing_counts(tracks(spark, sf), TRACK_COLUMNS)


_DESCRIBE = ("count({c}) AS count, round(avg({c}), 7) AS mean, round(stddev_samp({c}), 7) AS std, min({c}) AS min, "
             "round(quantile_cont({c}, 0.25), 7) AS p25, round(quantile_cont({c}, 0.5), 7) AS p50, "
             "round(quantile_cont({c}, 0.75), 7) AS p75, max({c}) AS max")


@query(on_tracks(per_column("tracks", NUMERIC, _DESCRIBE)))
def describe_stats(spark, sf):
    d = P.describe(tracks(spark, sf, busy=True), NUMERIC)
    return rounded(d, ["mean", "std", "p25", "p50", "p75"], 7)


@query(per_column("events", ["value"], _DESCRIBE) + " UNION ALL "
       + per_column("documents", ["n_chars"], _DESCRIBE))
def describe_native(spark, sf):
    d = P.describe(table(spark, sf, "events"), ["value"]).unionByName(
        P.describe(table(spark, sf, "documents"), ["n_chars"]))
    return rounded(d, ["mean", "std", "p25", "p50", "p75"], 7)


@query(on_tracks(per_column("tracks", NUMERIC, "round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurtosis")))
def skew_kurtosis(spark, sf):
    m = P.moments(tracks(spark, sf, busy=True), NUMERIC)
    return rounded(m.select("feature", "skew", "kurtosis"), ["skew", "kurtosis"])


def _corr_sql(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
        f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM {{t}}"
        for i, a in enumerate(columns) for b in columns[:i])


# A null in one column only: energy is blanked where the label is missing.
_HOLES = "holes AS (SELECT * REPLACE (CASE WHEN track_genre IS NOT NULL THEN energy END AS energy, CAST(explicit AS INT) AS explicit) FROM tracks)"


@query(on_tracks("SELECT feature_a, feature_b, round(r, 6) AS r FROM (" + _corr_sql(S.FEATURES).format(t="holes") + ")", _HOLES))
def corr_pairs(spark, sf):
    t = C.cast_bool(tracks(spark, sf, busy=True)).withColumn(
        "energy", F.when(F.col("track_genre").isNotNull(), F.col("energy")))
    return rounded(P.correlation_pairs(t, S.FEATURES), ["r"])


@query(on_tracks("SELECT feature_a, feature_b, round(r, 6) AS r FROM (" + _corr_sql(NUMERIC).format(t="tracks") + ") WHERE abs(r) > 0.3"))
def strong_correlations(spark, sf):
    pairs = P.strong_pairs(P.correlation_pairs(tracks(spark, sf, busy=True), NUMERIC))
    return rounded(pairs, ["r"])


_FENCES = "fences AS (SELECT feature, q1, q3, q1 - 3 * (q3 - q1) AS lower, q3 + 3 * (q3 - q1) AS upper FROM (" + per_column(
    "tracks", S.CLIP_FEATURES, "quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3") + "))"
_FENCES_OUT = ("SELECT feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower, "
               "round(upper, 6) AS upper FROM fences")


@query(on_tracks(_FENCES_OUT, _FENCES))
def iqr_fences(spark, sf):
    return rounded(C.fences(tracks(spark, sf, busy=True)), ["q1", "q3", "lower", "upper"])


@query(on_tracks(_FENCES_OUT, _FENCES))
def iqr_fences_ranged(spark, sf):
    """The same fences by the path for tables too large for the percentile aggregate."""
    f = C.fences(tracks(spark, sf, busy=True), percentile_rows=0)
    return rounded(f, ["q1", "q3", "lower", "upper"])


def _clip_sql(c: str) -> str:
    def fence(side):
        return f"(SELECT {side} FROM fences WHERE feature = '{c}')"
    x = f"CAST({c} AS DOUBLE)"
    return (f"round(CASE WHEN {x} < {fence('lower')} THEN {fence('lower')} "
            f"WHEN {x} > {fence('upper')} THEN {fence('upper')} ELSE {x} END, 6) AS {c}")


@query(on_tracks("SELECT track_id, " + ", ".join(_clip_sql(c) for c in S.CLIP_FEATURES) + " FROM tracks", _FENCES))
def winsorised(spark, sf):
    w = C.winsorise(tracks(spark, sf))
    return rounded(w.select("track_id", *S.CLIP_FEATURES), S.CLIP_FEATURES)


@query(on_tracks("SELECT feature, n_clipped, round_even(lower, 4) AS lower, round_even(upper, 4) AS upper FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT count(*) FROM tracks WHERE {c} < lower OR {c} > upper) AS n_clipped, lower, upper "
    f"FROM fences WHERE feature = '{c}'" for c in S.CLIP_FEATURES) + ")", _FENCES))
def clip_report(spark, sf):
    return C.clip_report(tracks(spark, sf))


_PROFILE = "SELECT super_genre, " + ", ".join(
    f"round_even(avg({c}), 3) AS {c}" for c in S.PROFILE_FEATURES) + " FROM mapped GROUP BY super_genre"


def _mapped(spark, sf, busy=False):
    return C.map_taxonomy(C.drop_null_target(tracks(spark, sf, busy)), out="super_genre")


@query(on_mapped(_PROFILE))
def group_profile(spark, sf):
    return P.group_profile(_mapped(spark, sf), "super_genre")


@query(on_mapped(
    "SELECT super_genre, feature, round((value - min(value) OVER (PARTITION BY feature)) / "
    "(max(value) OVER (PARTITION BY feature) - min(value) OVER (PARTITION BY feature) + 1e-9), 6) AS value FROM ("
    + unpivot("profile", S.PROFILE_FEATURES, "super_genre") + ")", f"profile AS ({_PROFILE})"))
def profile_minmax(spark, sf):
    return rounded(P.profile_minmax(P.group_profile(_mapped(spark, sf), "super_genre"), "super_genre"), ["value"])


def _histogram_sql(rows: str, keys: str, bins: int) -> str:
    on = " AND ".join(f"l.{k} = c.{k}" for k in keys.split(", "))
    lkeys = ", ".join(f"l.{k}" for k in keys.split(", "))
    rkeys = ", ".join(f"r.{k}" for k in keys.split(", "))
    rl = " AND ".join(f"r.{k} = l.{k}" for k in keys.split(", "))
    return f"""long AS ({rows}),
 lim AS (SELECT {keys}, count(*) AS total,
  CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS low,
  CASE WHEN min(value) = max(value) THEN CAST(1 AS DOUBLE) / {bins} ELSE (max(value) - min(value)) / {bins} END AS width
  FROM long WHERE value IS NOT NULL GROUP BY {keys}),
 cnt AS (SELECT {rkeys}, CAST(least(floor((value - low) / width), {bins - 1}) AS INT) AS bin, count(*) AS n
  FROM long r JOIN lim l ON {rl} WHERE value IS NOT NULL GROUP BY ALL),
 hist AS (SELECT {lkeys}, CAST(b.i AS INT) AS bin, low + b.i * width AS left_edge, coalesce(n, 0) AS n,
  round(coalesce(n, 0) / (total * width), 6) AS density
  FROM lim l CROSS JOIN range({bins}) b(i) LEFT JOIN cnt c ON {on} AND c.bin = b.i)"""


@query(on_tracks("SELECT * FROM hist", _histogram_sql(unpivot("tracks", NUMERIC), "feature", 40)))
def histogram(spark, sf):
    return rounded(P.histogram(tracks(spark, sf, busy=True), NUMERIC), ["density"])


_HIST_CLASS = ["acousticness", "energy", "danceability", "speechiness", "loudness", "valence"]


@query(on_mapped("SELECT * FROM hist", _histogram_sql(
    unpivot("mapped", _HIST_CLASS, "super_genre"), "super_genre, feature", 40)))
def histogram_by_class(spark, sf):
    h = P.histogram(_mapped(spark, sf, busy=True), _HIST_CLASS, by=["super_genre"])
    return rounded(h, ["density"])


_KDE = ["popularity", "tempo", "acousticness"]


@query(on_tracks("""SELECT feature, CAST(i AS INT) AS i, round(x, 6) AS x,
 round(sum(n * exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / (max(total) * max(h) * sqrt(2 * pi())), 6) AS density
 FROM (SELECT d.feature, g.i, low + g.i * step AS x, value, n, h, total
  FROM distinct_values d JOIN lim l ON d.feature = l.feature CROSS JOIN range(200) g(i)) GROUP BY feature, i, x""",
    f"long AS ({unpivot('tracks', _KDE)})",
    "distinct_values AS (SELECT feature, value, count(*) AS n FROM long GROUP BY feature, value)",
    """lim AS (SELECT feature, count(*) AS total, min(value) AS low, (max(value) - min(value)) / 199 AS step,
 stddev_samp(value) * pow(count(*), CAST(-0.2 AS DOUBLE)) AS h FROM long GROUP BY feature)"""))
def kde_grid(spark, sf):
    return rounded(P.kernel_density(tracks(spark, sf, busy=True), _KDE), ["x", "density"])


_CANDIDATES = [c for c in TRACK_COLUMNS if c not in S.ID_COLUMNS]
_TEXT = {"track_genre", "signal_genre"}


def _candidate_sql(c: str) -> str:
    score = 1 + (10 if any(k in c for k in S.TARGET_NAME_KEYWORDS) else 0) + (
        3 if c in _TEXT else 1 if c == "explicit" else 0)
    return (f"SELECT '{c}' AS \"column\", count(*) AS n_unique, count(*) / (SELECT count(*) FROM tracks) AS unique_fraction, "
            f"min(n) AS min_class_rows, CAST({score} AS DOUBLE) AS score "
            f"FROM (SELECT count(*) AS n FROM tracks WHERE {c} IS NOT NULL GROUP BY {c})")


@query(on_tracks("SELECT * FROM (" + " UNION ALL ".join(_candidate_sql(c) for c in _CANDIDATES)
                 + ") WHERE n_unique >= 2 AND unique_fraction <= 0.5 AND min_class_rows >= 10"))
def target_candidates(spark, sf):
    return P.target_candidates(tracks(spark, sf, busy=True).select(*TRACK_COLUMNS))


@query(on_tracks(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_null, count(*) FILTER (WHERE isnan(CAST({c} AS DOUBLE))) AS n_nan, "
    f"count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) AS n_infinite, count({c}) = 0 AS all_null FROM tracks"
    for c in S.FEATURES)))
def quality_checks(spark, sf):
    return P.quality_checks(C.cast_bool(tracks(spark, sf)), S.FEATURES)


_UPLOAD = ["track_id", "popularity", "energy", "tempo", "explicit"]
_FILLED = [c for c in S.FEATURES if c not in _UPLOAD]


@query(on_tracks("SELECT track_id, popularity, energy, tempo, CAST(explicit AS INT) AS explicit, "
                 + ", ".join(f"0 AS {c}" for c in _FILLED) + " FROM tracks"))
def missing_column_fill(spark, sf):
    uploaded = C.available(tracks(spark, sf), [*_UPLOAD, "album_name"])
    return C.cast_bool(C.add_missing_features(uploaded))


@query(on_tracks(
    "SELECT track_id, CASE WHEN track_genre IS NOT NULL THEN energy ELSE CAST(0.7 AS DOUBLE) END AS energy, "
    "popularity, duration_ms, CAST(explicit AS INT) AS explicit, "
    + ", ".join(f"{c}" if c in ("danceability", "loudness", "tempo") else
                (f"CAST({S.FEATURE_DOMAIN[c][2]} AS DOUBLE) AS {c}" if isinstance(S.FEATURE_DOMAIN[c][2], float)
                 else f"{S.FEATURE_DOMAIN[c][2]} AS {c}")
                for c in S.FEATURES if c not in ("energy", "popularity", "duration_ms", "explicit")) + " FROM tracks"))
def default_fill(spark, sf):
    t = tracks(spark, sf).withColumn("energy", F.when(F.col("track_genre").isNotNull(), F.col("energy")))
    partial = t.select("track_id", "energy", "popularity", "duration_ms", "explicit", "danceability", "loudness", "tempo")
    return C.fill_defaults(partial)


@query(on_tracks("""SELECT track_id, coalesce(e, (SELECT quantile_cont(e, 0.5) FROM b)) AS energy, coalesce(e, 0) AS energy_zero FROM b""",
                 "b AS (SELECT track_id, CASE WHEN track_genre IS NOT NULL THEN energy END AS e FROM tracks)"))
def null_cell_fill(spark, sf):
    b = tracks(spark, sf).select("track_id", F.when(F.col("track_genre").isNotNull(), F.col("energy")).alias("energy"))
    b = b.withColumn("energy_zero", F.col("energy"))
    return C.fill_zero(C.fill_median(b, ["energy"]), ["energy_zero"])


@query(on_tracks(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE CAST({c} AS DOUBLE) < {lo}) AS below, "
    f"count(*) FILTER (WHERE CAST({c} AS DOUBLE) > {hi}) AS above FROM tracks"
    for c, (lo, hi, _) in S.FEATURE_DOMAIN.items())))
def domain_violations(spark, sf):
    return C.domain_violations(tracks(spark, sf))


@query(on_tracks("SELECT track_genre, count(*) AS n, avg(popularity) AS mean_popularity FROM tracks "
                 "WHERE track_genre = 'techno' OR popularity > 95 GROUP BY track_genre"))
def filtered_rows(spark, sf):
    t = C.available(tracks(spark, sf), ["track_genre", "popularity", "no_such_column"])
    kept = t.filter((F.col("track_genre") == "techno") | (F.col("popularity") > 95))
    return kept.groupBy("track_genre").agg(F.count("*").alias("n"), F.avg("popularity").alias("mean_popularity"))


@query(on_tracks("SELECT track_id, " + ", ".join(S.FEATURES).replace("explicit", "CAST(explicit AS INT) AS explicit")
                 + ", track_genre FROM tracks WHERE track_genre IS NOT NULL"))
def model_input(spark, sf):
    t = C.cast_bool(C.drop_null_target(tracks(spark, sf)))
    return C.features_and_target(t, keep=["track_id"])


@query(on_tracks("SELECT track_id, track_name, popularity, duration_ms, explicit, danceability, energy, loudness, track_genre FROM tracks"))
def csv_round_trip(spark, sf):
    """Write the tracks as CSV (S7), find the file again (S1) and read it without an index (S3)."""
    columns = ["track_id", "track_name", "popularity", "duration_ms", "explicit", "danceability", "energy",
               "loudness", "track_genre"]
    path = scratch_dir(spark, "csv")
    files.write_csv(tracks(spark, sf).select(*columns), path)
    return files.read_upload_csv(spark, files.find_csv(spark, path))


@query(on_tracks("SELECT track_id, popularity, energy, tempo, track_genre FROM tracks"))
def csv_indexed_scan(spark, sf):
    """Write the full track layout with an index column and read it with the declared schema."""
    t = tracks(spark, sf)
    rows = t.select(
        F.monotonically_increasing_id().alias("index"),
        *[F.col(f.name) if f.name in t.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.TRACK_SCHEMA])
    path = scratch_dir(spark, "csv-indexed")
    files.write_csv(rows, path)
    return files.load_tracks(spark, path).select("track_id", "popularity", "energy", "tempo", "track_genre")


@query("SELECT event_id, value, max(value) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best FROM events")
def running_best(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return P.running_best(events, "event_id", "value")


@query(on_tracks("SELECT signal_genre, feature, prob, round(value, 6) AS value FROM (" + " UNION ALL ".join(
    f"SELECT signal_genre, '{c}' AS feature, CAST({p} AS DOUBLE) AS prob, quantile_cont(CAST({c} AS DOUBLE), {p}) AS value "
    f"FROM tracks GROUP BY signal_genre" for c in ("loudness", "tempo") for p in (0.1, 0.5, 0.9)) + ")"))
def quantiles_by_class(spark, sf):
    q = O.quantiles(tracks(spark, sf, busy=True), ["loudness", "tempo"], [0.1, 0.5, 0.9], by=["signal_genre"],
                    percentile_rows=0)
    return rounded(q, ["value"])


@query("SELECT l_returnflag, count(*) AS n, min(value) AS low, max(value) AS high FROM ("
       + unpivot("lineitem", ["l_quantity", "l_discount"], "l_returnflag") + ") GROUP BY l_returnflag")
def melted_line_items(spark, sf):
    rows = melt(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], keep=["l_returnflag"])
    return rows.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


@query(on_tracks("SELECT track_id, " + ", ".join(
    f"CAST({'CAST(explicit AS INT)' if c == 'explicit' else c} AS DOUBLE) AS {c}" for c in S.FEATURES) + " FROM tracks"))
def double_features(spark, sf):
    """All model inputs as doubles."""
    return C.features_as_double(tracks(spark, sf), keep=["track_id"])


@query(on_tracks("SELECT track_id, track_name, popularity FROM tracks ORDER BY track_id LIMIT 500"))
def capped_rows(spark, sf):
    """The first 500 rows in order of the id: the optional cap is the feature."""
    return C.handle_row_cap(tracks(spark, sf), "track_id", rows=500).select("track_id", "track_name", "popularity")
