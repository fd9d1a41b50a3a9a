"""Hand-computed results for ties, nulls, constants, zero divisions and empty classes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.functions.features import engineer, feature_names, search_url, top_gap
from tracklab.operators import cleaning as C
from tracklab.operators import metrics as E
from tracklab.operators import moodtext as M
from tracklab.operators import mutual_info as I
from tracklab.operators import ordered as O
from tracklab.operators import profile as P
from tracklab.operators import recommend as R
from tracklab.operators import split as X
from tracklab.operators.knn import knn_vote
from tracklab.operators.small import checked_broadcast, half_even, literal_table, small_rows


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# counts -------------------------------------------------------------------

def test_value_counts_nulls_in_denominator_and_ties_by_label(spark):
    df = literal_table(spark, [("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "g string")
    assert rows(P.value_counts(df, "g")) == [("a", 2, 33.33), ("b", 2, 33.33), ("c", 1, 16.67)]


def test_class_balance_one_class(spark):
    df = literal_table(spark, [("a",), ("a",), (None,)], "g string")
    assert rows(P.class_balance(df, "g")) == [(1, 2, 2, 2.0, True)]


def test_half_even(spark):
    df = literal_table(spark, [(0.125,), (0.375,), (-0.125,)], "x double")
    assert [r[0] for r in rows(df.select(half_even(F.col("x"), 2)))] == [0.12, 0.38, -0.12]


def test_missing_counts(spark):
    df = literal_table(spark, [(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(P.missing_counts(df)) == [("b", 2, 66.6667), ("a", 1, 33.3333)]


# moments ------------------------------------------------------------------

def test_moments_small_and_constant(spark):
    df = literal_table(spark, [(1.0, 5.0, 1.0), (2.0, 5.0, None), (4.0, 5.0, None)],
                       "x double, c double, one double")
    got = {r["feature"]: r for r in P.moments(df, ["x", "c", "one"]).collect()}
    assert got["x"]["skew"] == pytest.approx(0.935220)
    assert got["x"]["kurtosis"] is None
    assert (got["c"]["std"], got["c"]["skew"]) == (0.0, 0.0)
    assert (got["one"]["count"], got["one"]["std"], got["one"]["skew"]) == (1, None, None)


def test_nan_becomes_null_before_statistics(spark):
    df = C.nan_to_null(literal_table(spark, [(1.0,), (float("nan"),), (4.0,)], "x double"))
    q = O.quantiles(df, ["x"], [0.25])
    assert q.first()["value"] == 1.75
    assert P.moments(df, ["x"]).first()["max"] == 4.0


def test_correlation_constant_and_pairwise_nulls(spark):
    data = [(1.0, 2.0, 7.0), (2.0, 1.0, 7.0), (3.0, None, 7.0), (4.0, 5.0, 7.0)]
    got = {(a, b): r for a, b, r in rows(P.correlation_pairs(
        literal_table(spark, data, "x double, y double, c double"), ["x", "y", "c"]))}
    assert got[("y", "x")] == pytest.approx(np.corrcoef([1, 2, 4], [2, 1, 5])[0, 1])
    assert got[("c", "x")] is None and got[("c", "y")] is None


# order statistics ---------------------------------------------------------

@pytest.mark.parametrize("values", [
    [3.0], [1.0, 2.0], [5.0] * 50, list(range(1000)), [0.0] * 900 + list(range(100)), [1.5, None, -2.0, 1.5],
])
def test_ranged_quantiles_equal_percentile(spark, values):
    df = literal_table(spark, [("g", v if v is None else float(v)) for v in values], "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    small = rows(O.quantiles(df, ["x"], probs, by=["g"]))
    large = rows(O.quantiles(df, ["x"], probs, by=["g"], percentile_rows=0))
    assert [r[:3] for r in sorted(large)] == [r[:3] for r in sorted(small)]
    assert [r[3] for r in sorted(large)] == pytest.approx([r[3] for r in sorted(small)])


def test_literal_ranges(spark):
    df = literal_table(spark, [(float(v),) for v in range(-2, 9)], "x double")
    for edges in ([], [0.0], [0.0, 3.0, 3.0, 7.5]):
        got = rows(df.select("x", O.literal_range_of(edges, F.col("x"))))
        assert all(n == sum(e <= x for e in edges) for x, n in got)


@pytest.mark.parametrize("rows_limit", [None, 0])
def test_running_totals_and_max(spark, rows_limit):
    n = 3000
    df = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("x"), (F.col("id") * 7919 % 101).alias("w"))
    w = [i * 7919 % 101 for i in range(n)]
    total = {r["x"]: r["t"] for r in O.running_totals(df, ["k"], "x", {"t": "w"}, plain_rows=rows_limit).collect()}
    best = {r["x"]: r["m"] for r in O.running_max(df, ["k"], "x", {"m": "w"}, plain_rows=rows_limit).collect()}
    assert [total[i] for i in range(n)] == list(np.cumsum(w))
    assert [best[i] for i in range(n)] == list(np.maximum.accumulate(w))


# fences -------------------------------------------------------------------

def test_fence_zero_iqr_nulls_and_value_on_fence(spark):
    df = literal_table(spark, [(1.0,), (1.0,), (1.0,), (1.0,), (9.0,), (None,)], "tempo double")
    limits = C.fit_fences(df)
    assert limits == {"tempo": (1.0, 1.0)}
    assert sorted(rows(C.winsorise(df, limits)), key=str) == sorted([(1.0,)] * 5 + [(None,)], key=str)
    assert rows(C.clip_report(df, limits)) == [("tempo", 1, 1.0, 1.0)]


# features -----------------------------------------------------------------

def _record(**changes):
    base = {c: default for c, (_, _, default) in S.FEATURE_DOMAIN.items()} | changes
    return tuple(None if base[c] is None else float(base[c]) for c in S.FEATURES)


def test_feature_boundaries(spark):
    schema = ", ".join(f"`{c}` double" for c in S.FEATURES)
    df = literal_table(spark, [
        _record(energy=0.0, loudness=-6.0), _record(tempo=90), _record(tempo=140), _record(tempo=None),
        _record(speechiness=-0.5, loudness=3.0)], schema)
    got = engineer(df).collect()
    assert got[0]["loudness_per_energy"] == pytest.approx(6e6)
    assert (got[1]["tempo_slow"], got[2]["tempo_fast"]) == (0.0, 0.0)
    assert (got[3]["tempo_slow"], got[3]["tempo_fast"], got[3]["tempo_sq"]) == (0.0, 0.0, None)
    assert (got[4]["log1p_speechiness"], got[4]["abs_loudness"]) == (0.0, 3.0)
    assert got[0].asDict().keys() == set(feature_names()) and len(feature_names()) == 42


def test_search_url(spark):
    df = literal_table(spark, [("r&b / soul+funk~*é",)], "q string")
    assert rows(df.select(search_url(F.col("q")))) == [
        ("https://open.spotify.com/search/r%26b%20/%20soul%2Bfunk~%2A%C3%A9",)]


def test_defaults_and_missing_columns(spark):
    df = literal_table(spark, [(True, None)], "explicit boolean, energy double")
    filled = C.fill_defaults(df).first()
    assert (filled["explicit"], filled["energy"], filled["tempo"], filled["popularity"]) == (1, 0.7, 120.0, 50)
    zero = C.add_missing_features(df).first()
    assert zero["energy"] is None and zero["tempo"] == 0
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        C.features_as_double(df).collect()


def test_unseen_label_raises(spark):
    codes = literal_table(spark, [("a", 0)], "label string, code int")
    df = literal_table(spark, [("a",), ("z",)], "g string")
    with pytest.raises(Exception, match="unseen label: z"):
        C.encode_labels(df, "g", codes=codes).collect()


# target discovery ---------------------------------------------------------

def test_target_gates(spark):
    n = 40
    df = spark.range(n).select(
        F.col("id").cast("string").alias("track_id"),
        (F.col("id") % 4).cast("string").alias("mood_b"),       # 10 rows each: kept
        (F.col("id") % 2).cast("string").alias("mood_a"),       # same score: alphabetical first
        (F.col("id") % 5).cast("string").alias("genre"),        # 8 rows each: too rare
        F.lit("x").alias("label"),                              # one class
        (F.col("id") % 2 == 0).alias("flag"),
    )
    got = rows(P.target_candidates(df), "column", "score")
    assert got == [("mood_a", 14.0), ("mood_b", 14.0), ("flag", 2.0)]
    assert P.discover_target(df) == "mood_a"
    with pytest.raises(ValueError):
        P.discover_target(df.select("genre", "label"))


# splits -------------------------------------------------------------------

def test_split_sizes_follow_quotas(spark):
    counts = {"a": 33, "b": 33, "c": 34}
    data = [(f"{c}{i}", c) for c, n in counts.items() for i in range(n)]
    df = X.stratified_split(literal_table(spark, data, "id string, g string"), "g", ["id"])
    got = {(r["g"], r["split"]): r["count"] for r in df.groupBy("g", "split").count().collect()}
    quotas = X.split_quotas(counts)
    for c, (test, val) in quotas.items():
        assert (got[(c, "test")], got[(c, "val")], got[(c, "train")]) == (test, val, counts[c] - test - val)
    assert sum(t for t, _ in quotas.values()) == 15


def test_published_split_sizes():
    counts = {c: 1000 * len(raws) for c, raws in S.TAXONOMY.items()}
    quotas = X.split_quotas(counts)
    assert sum(counts.values()) == 114_000
    assert sum(t for t, _ in quotas.values()) == 17_100
    assert sum(v for _, v in quotas.values()) == 17_100
    assert quotas["dance"][0] == 6750 and quotas["vocal"][0] == 1050


def test_split_needs_two_rows_per_class_and_unique_ids(spark):
    with pytest.raises(ValueError):
        X.stratified_split(literal_table(spark, [("1", "a")], "id string, g string"), "g", ["id"])
    doubled = literal_table(spark, [("1", "a")] * 8, "id string, g string")
    with pytest.raises(ValueError, match="not unique"):
        X.stratified_split(doubled, "g", ["id"])


def test_sample_and_folds(spark):
    df = literal_table(spark, [(str(i), "ab"[i % 3 == 0]) for i in range(100)], "id string, g string")
    assert X.stratified_sample(df, "g", ["id"], 500) is df
    sample = X.stratified_sample(df, "g", ["id"], 30)
    assert sample.count() == 30
    folds = X.stratified_folds(df, "g", ["id"], 3).groupBy("g", "fold").count().collect()
    for g in "ab":
        sizes = [r["count"] for r in folds if r["g"] == g]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_cuts_agree_with_a_full_sort(spark, monkeypatch, digits):
    monkeypatch.setattr(X, "RANGE_DIGITS", digits)
    df = literal_table(spark, [(str(i), "ab"[i % 7 == 0]) for i in range(500)], "id string, g string")
    got = {r["id"] for r in X.stratified_sample(df, "g", ["id"], 100).collect()}
    keyed = df.withColumn("k", X.hash_key(["id"])).collect()
    quota = X.allocate(100, {"a": 428, "b": 72})
    want = {r["id"] for c, n in quota.items()
            for r in sorted((r for r in keyed if r["g"] == c), key=lambda r: r["k"])[:n]}
    assert got == want


# metrics ------------------------------------------------------------------

def test_confusion_with_absent_classes(spark):
    df = literal_table(spark, [("a", "a"), ("a", "c"), ("b", "c")], "y_true string, y_pred string")
    m = E.confusion(df)
    assert m.count() == 9
    by = {r["label"]: r for r in E.per_class(m).collect()}
    assert (by["b"]["precision"], by["b"]["recall"], by["b"]["f1"]) == (0.0, 0.0, 0.0)   # never predicted
    assert (by["c"]["support"], by["c"]["recall"], by["c"]["predicted"]) == (0, 0.0, 2)  # only predicted
    shares = {(a, b): s for a, b, s in rows(E.confusion_shares(m))}
    assert shares[("c", "a")] is None and shares[("a", "a")] == 0.5
    row = E.metric_row(m).first()
    assert row["accuracy"] == pytest.approx(1 / 3)
    assert row["weighted_f1"] == pytest.approx(2 / 3 * 2 / 3)
    assert row["macro_f1"] == pytest.approx(2 / 9)
    worst = {r["y_true"]: (r["confused_with"], r["confused_n"]) for r in E.main_confusion(m).collect()}
    assert worst == {"a": ("c", 1), "b": ("c", 1), "c": (None, None)}


def test_confusion_with_nulls(spark):
    df = literal_table(spark, [("a", "a"), ("a", None), ("b", "a"), (None, "a"), (None, None)], "y_true string, y_pred string")
    m = E.confusion(df)
    assert sorted(rows(m), key=str) == sorted([("a", "a", 1), ("a", "b", 0), ("a", None, 1), ("b", "a", 1), ("b", "b", 0)], key=str)
    got = {r["label"]: (r["tp"], r["support"], r["predicted"]) for r in E.per_class(m).collect()}
    assert got == {"a": (1, 2, 2), "b": (0, 1, 0)}
    assert E.metric_row(m).first()["accuracy"] == pytest.approx(1 / 3)


def test_confusion_of_many_labels(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("y_true"), F.col("id").cast("string").alias("y_pred"))
    assert E.metric_row(E.confusion(df)).first()["accuracy"] == 1


def test_improvement_log_only_below_target(spark):
    bad = E.confusion(literal_table(spark, [("a", "b"), ("b", "b")], "y_true string, y_pred string"))
    good = E.confusion(literal_table(spark, [("a", "a"), ("b", "b")], "y_true string, y_pred string"))
    assert rows(E.improvement_log(bad)) == [(0.5, pytest.approx(0.3), "none so far")]
    assert rows(E.improvement_log(good)) == []


@pytest.mark.parametrize("plain_rows", [None, 0])
def test_auc_ties_equal_scores_and_absent_class(spark, plain_rows):
    data = [("a", 0.9, 0.5), ("b", 0.9, 0.5), ("a", 0.4, 0.5), ("b", 0.1, 0.5)]
    df = literal_table(spark, data, "y_true string, p_a double, p_b double")
    got = dict(rows(E.auc_per_class(df, {"a": "p_a", "b": "p_b", "z": "p_a"}, plain_rows=plain_rows)))
    assert got == {"a": 0.625, "b": 0.5, "z": None}
    aucs = E.auc_per_class(df, {"a": "p_a", "z": "p_a"})
    assert E.macro_auc(aucs, ["a", "z"]).first()["macro_auc"] is None
    assert E.macro_auc(aucs.filter("class = 'a'"), ["a"]).first()["macro_auc"] == 0.625


def test_gap_and_median(spark):
    df = literal_table(spark, [([0.2, 0.7, 0.1],)], "p array<double>")
    assert rows(df.select(top_gap(F.col("p"))))[0][0] == pytest.approx(0.5)


# top-k --------------------------------------------------------------------

def test_top_tracks_short_label_and_ties(spark):
    data = [("t2", "x", 5), ("t1", "x", 5), ("t3", "x", 9), ("t4", "y", 1), ("t5", None, 99)]
    df = literal_table(spark, data, "track_id string, track_genre string, popularity int")
    got = rows(R.top_tracks(df, k=2).orderBy("track_genre", "rank"), "track_id", "rank")
    assert got == [("t3", 1), ("t1", 2), ("t4", 1)]


def test_tagline_of_unknown_class_raises(spark):
    with pytest.raises(Exception, match="unknown class: polka"):
        R.with_tagline(literal_table(spark, [("polka",)], "g string"), "g").collect()
    assert R.recommend_playlists(literal_table(spark, [("polka",)], "g string"), "g").count() == 0


# text ---------------------------------------------------------------------

def test_quick_moods(spark):
    df = literal_table(spark, [(i, t) for i, t in enumerate(S.QUICK_MOODS)], "i int, text string")
    got = {r["i"]: r for r in M.mood(df).collect()}
    assert [got[i]["mood"] for i in range(8)] == [
        "dance", "acoustic", "heavy", "acoustic", "heavy", "vocal", "acoustic", "dance"]
    assert got[0]["share_dance"] == pytest.approx(2 / 3) and got[0]["share_electronic"] == pytest.approx(1 / 3)


def test_mood_edge_texts(spark):
    texts = ["", None, "zzz", "EXPRESSIVE", "calm techno", "guitar indie work bass"]
    df = literal_table(spark, list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r for r in M.mood(df).collect()}
    for i in (0, 1, 2):
        assert got[i]["mood"] == "dance" and got[i]["share_heavy"] == pytest.approx(1 / 6)
    assert got[3]["mood"] == "vocal"
    assert got[4]["mood"] == "acoustic"      # tie: earlier class
    assert got[5]["mood"] == "alternative"   # tie of two hits each
    assert sum(len(v) for v in S.MOOD_KEYWORDS.values()) == 131


def test_free_text_overrides_quick_choice(spark):
    df = literal_table(spark, [("", "q"), (None, "q"), ("free", "q")], "a string, b string")
    assert [r[0] for r in rows(df.select(M.active_text(F.col("a"), F.col("b"))))] == ["q", "q", "free"]


# mutual information and neighbours ------------------------------------------

def _digamma(n):
    return -I.EULER_GAMMA + sum(1 / i for i in range(1, n))


def _brute_mi(values, labels, k=3):
    values, labels = np.array(values, float), np.array(labels)
    keep = np.array([np.sum(labels == c) > 1 for c in labels])
    values, labels = values[keep], labels[keep]
    terms = []
    for x, c in zip(values, labels):
        same = np.sort(np.abs(values[labels == c] - x))
        size = len(same)
        kk = min(k, size - 1)
        d = same[kk]
        gap = np.abs(values - x)
        m = int(np.sum(gap < d)) if d > 0 else int(np.sum(gap == 0))
        terms.append(_digamma(kk) - _digamma(size) - _digamma(m))
    return max(0.0, _digamma(len(values)) + float(np.mean(terms)))


@pytest.mark.parametrize("ties", ["", "binary", "decimal", "far"])
@pytest.mark.parametrize("plain_rows", [None, 0])
def test_knn_mi_equals_brute_force(spark, ties, plain_rows):
    rng = np.random.default_rng(7)
    labels = rng.choice(["a", "b", "c"], 600, p=[0.6, 0.3, 0.1]).tolist() + ["single", "p", "p"]
    values = rng.normal(size=603) + np.array([{"a": 0, "b": 1.5}.get(c, -1) for c in labels])
    if ties == "binary":
        values = np.floor(values * 8) / 8    # exact in binary, with many equal values
    elif ties:
        values = np.round(values * 100, 1) / 100 + 1000 * (ties == "far")    # sums of decimals are rounded
    df = literal_table(spark, list(zip(labels, values.tolist())), "g string, x double")
    assert I.knn_mi(df, ["x"], "g", plain_rows=plain_rows).first()["mutual_info"] == pytest.approx(_brute_mi(values, labels), abs=1e-9)


def test_digamma(spark):
    df = literal_table(spark, [(n,) for n in (1, 2, 10, 11, 50, 5000)], "n long")
    got = [r[0] for r in rows(df.select(I.digamma(F.col("n"))))]
    assert got == pytest.approx([_digamma(n) for n in (1, 2, 10, 11, 50, 5000)], abs=1e-11)


def test_knn_vote_paths_and_ties(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.integers(0, 4, 3).astype(float).tolist(), int(rng.integers(0, 3))) for i in range(120)]
    df = literal_table(spark, data, "id long, x array<double>, label int")
    x = np.array([d[1] for d in data])
    want = {}
    for i in range(120):
        d = ((x - x[i]) ** 2).sum(1)
        near = [j for j in sorted(range(120), key=lambda j: (d[j], j)) if j != i][:5]
        votes = np.bincount([data[j][2] for j in near])
        want[i] = float(np.argmax(votes))
    for options in ({}, {"broadcast_cells": 1, "block_rows": 25}):
        got = {r["id"]: r["prediction"] for r in knn_vote(df.select("id", "x"), df, 5, True, **options).collect()}
        assert got == want


# small sides --------------------------------------------------------------

def test_checked_broadcast_respects_its_bound(spark):
    df = spark.range(50)
    assert "ResolvedHint" in checked_broadcast(df, 50)._jdf.queryExecution().analyzed().toString()
    assert checked_broadcast(df, 49) is df
    with pytest.raises(ValueError):
        small_rows(df, 49)


def test_kernel_density_integrates_to_one(spark):
    rng = np.random.default_rng(1)
    df = literal_table(spark, [(float(v), 1.0) for v in rng.normal(size=400)], "x double, c double")
    grid = P.kernel_density(df, ["x", "c"]).orderBy("i").collect()
    assert {r["feature"] for r in grid} == {"x"} and len(grid) == 200
    area = sum(r["density"] for r in grid) * (grid[1]["x"] - grid[0]["x"])
    assert 0.95 < area < 1.01
    assert math.isfinite(grid[0]["density"])


@pytest.mark.parametrize("values", [
    np.random.default_rng(2).normal(size=3000), np.random.default_rng(3).exponential(size=2000) ** 3, np.repeat([0.0, 1.0, 50.0], 40)])
def test_kernel_density_equals_the_sum_of_kernels(spark, values):
    df = literal_table(spark, [(float(v),) for v in values], "x double").repartition(4)
    got = {r["i"]: (r["x"], r["density"]) for r in P.kernel_density(df, ["x"], points=120).collect()}
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = values.min() + np.arange(120) * (values.max() - values.min()) / 119
    want = [np.exp(-0.5 * ((g - values) / h) ** 2).sum() / (len(values) * h * math.sqrt(2 * math.pi)) for g in grid]
    assert [got[i][0] for i in range(120)] == pytest.approx(grid.tolist(), abs=1e-9)
    assert [got[i][1] for i in range(120)] == pytest.approx(want, abs=1e-12 / h + 1e-13)


def test_label_codes_over_ranges(spark):
    labels = [f"label {i:04d}" for i in range(700)] + ["", "Z", "é"]
    df = literal_table(spark, [(x,) for x in labels * 2 + [None]], "c string").repartition(7)
    got = {r["label"]: r["code"] for r in C.label_codes(df, "c").collect()}
    assert got == {x: i for i, x in enumerate(sorted(labels))}
    assert C.label_codes(df.limit(0), "c").count() == 0


def test_histogram_constant_and_empty_bins(spark):
    df = literal_table(spark, [(2.0, 0.0), (2.0, 1.0), (2.0, None)], "c double, x double")
    got = {(r["feature"], r["bin"]): r["n"] for r in P.histogram(df, ["c", "x"], bins=4).collect()}
    assert got == {("c", 0): 0, ("c", 1): 0, ("c", 2): 3, ("c", 3): 0, ("x", 0): 1, ("x", 1): 0, ("x", 2): 0, ("x", 3): 1}
