"""Single-pass profiling: counts, missing cells, moments, correlations, histograms."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tracklab import schema as S
from tracklab.operators.cleaning import numeric_columns
from tracklab.operators.ordered import PERCENTILE_ROWS, quantiles, running_max
from tracklab.operators.small import (checked_broadcast, column_ranges, column_sums, div, half_even, literal_table,
                                      melt)


def schema_report(df: DataFrame) -> DataFrame:
    """(pos, column, dtype, nullable, n_rows)."""
    fields = literal_table(
        df.sparkSession,
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)],
        "pos int, column string, dtype string, nullable boolean",
    )
    return fields.withColumn("n_rows", F.lit(df.count()))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(label, count, percentage): nulls are not a label but are in the denominator."""
    grouped = df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("count"))
    total = grouped.agg(F.sum("count")).scalar()
    # Filtering on the share keeps the null group in the aggregate, so that total and
    # rows come from one scan.
    share = F.when(F.col("label").isNotNull(), half_even(div(F.col("count"), total) * 100, 2))
    return (
        grouped.withColumn("percentage", share).filter("percentage IS NOT NULL")
        .orderBy(F.desc("count"), "label")
    )


def class_balance(df: DataFrame, column: str) -> DataFrame:
    """One row: n_classes, min, max, mean rows per class and whether they differ by under 5 %."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return counts.agg(
        F.count("*").alias("n_classes"),
        F.min("count").alias("min_count"),
        F.max("count").alias("max_count"),
        F.avg("count").alias("mean_count"),
    ).withColumn(
        "balanced", div(F.col("max_count") - F.col("min_count"), F.col("max_count")) < 0.05
    )


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_count, missing_pct) for columns with missing cells, most first."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_count")) for c in columns
    ])
    return (
        counts.select("_n", F.inline(pairs))
        .filter("missing_count > 0")
        .select("column", "missing_count",
                half_even(div(F.col("missing_count"), F.col("_n")) * 100, 4).alias("missing_pct"))
        .orderBy(F.desc("missing_count"), "column")
    )


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, count, mean, std, min, max, skew, kurtosis), bias-corrected.

    Two passes: central sums are taken around the known mean, so they do not cancel.
    """
    first = column_ranges(df, columns)
    powers = {}
    for c in columns:
        d = F.col(c).cast("double") - F.lit(first[c][1]).cast("double")
        powers |= {(c, 1): d, (c, 2): d * d, (c, 3): d * d * d, (c, 4): d * d * d * d}
    sums = column_sums(df, powers)
    rows = [_shape(c, *first[c], *(sums[(c, i)] for i in (1, 2, 3, 4))) for c in columns]
    return literal_table(
        df.sparkSession, rows,
        "feature string, count long, mean double, std double, min double, max double, "
        "skew double, kurtosis double",
    )


def _shape(name, n, mean, low, high, s1, s2, s3, s4):
    """Sample std, G1 and G2 from central sums (s1 removes the rounding of the mean)."""
    std = skew = kurtosis = None
    if n:
        e = s1 / n
        m2 = s2 / n - e * e
        m3 = s3 / n - 3 * e * (s2 / n) + 2 * e ** 3
        m4 = s4 / n - 4 * e * (s3 / n) + 6 * e * e * (s2 / n) - 3 * e ** 4
        flat = low == high
        if n > 1:
            std = 0.0 if flat else (m2 * n / (n - 1)) ** 0.5
        if n > 2:
            skew = 0.0 if flat else m3 / m2 ** 1.5 * (n * (n - 1)) ** 0.5 / (n - 2)
        if n > 3:
            kurtosis = 0.0 if flat else (
                (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2 ** 2 - 3) + 6)
            )
    return name, n, mean, std, low, high, skew, kurtosis


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             percentile_rows: int = PERCENTILE_ROWS) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75], percentile_rows=percentile_rows)
    q = quartiles.groupBy("feature").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ])
    return moments(df, columns).join(q, "feature").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature_a, feature_b, r) for every pair a after b in column order, pairwise complete.

    Columns are centred with the first pass; the second sums products: one per pair of
    columns without nulls, six per pair with nulls.
    """
    columns = list(columns or numeric_columns(df))
    first = column_ranges(df, columns)
    n = df.count()
    varying = [c for c in columns if first[c][0] and first[c][2] < first[c][3]]
    complete = {c for c in varying if first[c][0] == n}
    d = {c: F.col(c).cast("double") - F.lit(first[c][1]) for c in varying}
    pairs = [(a, b) for b, a in combinations(varying, 2)]
    terms = {(c, c): d[c] * d[c] for c in varying}
    for a, b in pairs:
        terms[(a, b)] = d[a] * d[b]
        if a not in complete or b not in complete:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            terms |= {(a, b, name): F.when(both, x) for name, x in (
                ("n", F.lit(1.0)), ("a", d[a]), ("b", d[b]), ("aa", d[a] * d[a]), ("bb", d[b] * d[b]))}
    sums = column_sums(df, terms) if pairs else {}
    r = {pair: _pair_r(sums, *pair) for pair in pairs}
    rows = [(a, b, r.get((a, b))) for b, a in combinations(columns, 2)]
    return literal_table(df.sparkSession, rows, "feature_a string, feature_b string, r double")


def _pair_r(sums, a, b):
    """Pearson r of one pair from its sums of centred values."""
    if (a, b, "n") not in sums:
        return sums[(a, b)] / (sums[(a, a)] * sums[(b, b)]) ** 0.5
    m = sums[(a, b, "n")]
    if not m:
        return None
    sa, sb = sums[(a, b, "a")], sums[(a, b, "b")]
    va, vb = sums[(a, b, "aa")] - sa * sa / m, sums[(a, b, "bb")] - sb * sb / m
    if va <= 1e-12 * sums[(a, a)] or vb <= 1e-12 * sums[(b, b)]:
        return None
    return (sums[(a, b)] - sa * sb / m) / (va * vb) ** 0.5


def strong_pairs(pairs: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Pairs with |r| above the threshold, largest r first."""
    return pairs.filter((F.abs("r") > threshold) & (F.col("feature_a") != F.col("feature_b"))).orderBy(
        F.desc("r"), "feature_a", "feature_b"
    )


def group_profile(df: DataFrame, by: str, columns: Sequence[str] = tuple(S.PROFILE_FEATURES)) -> DataFrame:
    """Mean of each column per class, rounded to 3 digits."""
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        *[half_even(F.avg(c), 3).alias(c) for c in columns]
    ).orderBy(by)


def profile_minmax(profile: DataFrame, by: str, columns: Sequence[str] = tuple(S.PROFILE_FEATURES)) -> DataFrame:
    """(class, feature, value): each column of the profile scaled to [0, 1] over the classes."""
    rows = melt(profile, columns, keep=[by])
    w = W.partitionBy("feature")
    low, high = F.min("value").over(w), F.max("value").over(w)
    return rows.select(by, "feature", ((F.col("value") - low) / (high - low + F.lit(1e-9))).alias("value"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 40, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, bin, left_edge, n, density), empty bins included.

    Each (group, column) uses its own value range; the last bin is closed; a constant
    column gets the range [x - 0.5, x + 0.5].  One pass finds the ranges, one counts.
    """
    by = list(by)
    keys = [*by, "feature"]
    rows = melt(df, columns, keep=by).filter(F.col("value").isNotNull())
    for c in by:
        rows = rows.filter(F.col(c).isNotNull())
    limits = rows.groupBy(*keys).agg(
        F.min("value").alias("_min"), F.max("value").alias("_max"), F.count("*").alias("_total")
    )
    flat = F.col("_min") == F.col("_max")
    limits = limits.select(
        *keys, "_total",
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_low"),
        F.when(flat, F.lit(1.0) / bins).otherwise((F.col("_max") - F.col("_min")) / bins).alias("_width"),
    )
    limits = checked_broadcast(limits)
    position = F.floor((F.col("value") - F.col("_low")) / F.col("_width"))
    counts = (
        rows.join(limits, keys)
        .groupBy(*keys, F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    grid = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce("n", F.lit(0))
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("left_edge"),
        n.alias("n"),
        (n / (F.col("_total") * F.col("_width"))).alias("density"),
    )


# Cells of a bandwidth in which values are gathered, and the bandwidths after which a kernel ends (below 1e-17 of its peak).
KERNEL_CELLS, KERNEL_REACH = 1024, 9


def kernel_density(df: DataFrame, columns: Sequence[str], points: int = 200) -> DataFrame:
    """(feature, i, x, density): Gaussian kernel on an even grid, Scott bandwidth.

    Values are gathered in cells of a ``KERNEL_CELLS``th of the bandwidth, each with the count and the
    first three moments of the distances to its middle in bandwidths.  A cell adds the kernel's
    expansion to the grid points within its reach, so the work is bounded by the number of
    cells, whatever the number of rows or distinct values.  What the expansion leaves out is below
    (1 / 2048) ** 4 / 24 * 1.2 < 3e-15 of a value's weight per bandwidth.  Constant columns have no
    density and are left out.
    """
    rows = melt(df, columns).filter(F.col("value").isNotNull())
    stats = rows.groupBy("feature").agg(
        F.count("*").alias("_n"), F.stddev_samp("value").alias("_std"),
        F.min("value").alias("_min"), F.max("value").alias("_max"),
    ).filter("_max > _min").select(
        "feature", "_n", "_min",
        ((F.col("_max") - F.col("_min")) / (points - 1)).alias("_step"),
        (F.col("_std") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias("_h"),
    )
    stats = checked_broadcast(stats)
    width = F.col("_h") / KERNEL_CELLS
    placed = rows.join(stats, "feature").withColumn("_cell", F.floor((F.col("value") - F.col("_min")) / width))
    middle = F.col("_min") + (F.col("_cell") + 0.5) * width
    t = (F.col("value") - middle) / F.col("_h")
    cells = placed.groupBy("feature", "_cell").agg(
        F.count("*").alias("_c"), F.sum(t).alias("_s1"), F.sum(t * t).alias("_s2"), F.sum(t * t * t).alias("_s3")).join(stats, "feature")
    reach = KERNEL_REACH * F.col("_h")
    low = F.greatest(F.ceil((middle - reach - F.col("_min")) / F.col("_step")), F.lit(0))
    high = F.least(F.floor((middle + reach - F.col("_min")) / F.col("_step")), F.lit(points - 1))
    near = cells.withColumns({"_low": low.cast("int"), "_high": high.cast("int")}).filter("_low <= _high").withColumn(
        "i", F.explode(F.sequence("_low", "_high")))
    x = F.col("_min") + F.col("i") * F.col("_step")
    u = (x - middle) / F.col("_h")
    kernel = F.exp(u * u * -0.5) * (F.col("_c") + u * F.col("_s1") + (u * u - 1) / 2 * F.col("_s2") + (u * u * u - u * 3) / 6 * F.col("_s3"))
    sums = near.select("feature", "i", kernel.alias("_k"))
    grid = stats.select("feature", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"), F.lit(0.0).alias("_k"))
    return (
        sums.unionByName(grid).groupBy("feature", "i").agg(F.sum("_k").alias("_k")).join(stats, "feature")
        .select("feature", "i", x.alias("x"), (F.col("_k") / (F.col("_n") * F.col("_h") * F.sqrt(2 * F.pi()))).alias("density"))
    )


def value_frequency(df: DataFrame, columns: Sequence[str], n: int | None = None) -> DataFrame:
    """(column, n_unique, unique_fraction, min_class_rows) with one shuffle for all columns."""
    n = df.count() if n is None else n
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("cell")) for c in columns
    ]))).filter("cell is not null")
    return (
        cells.groupBy("column", "cell").agg(F.count("*").alias("rows"))
        .groupBy("column").agg(F.count("*").alias("n_unique"), F.min("rows").alias("min_class_rows"))
        .select("column", "n_unique", (F.col("n_unique") / F.lit(n)).alias("unique_fraction"),
                "min_class_rows")
    )


def target_candidates(df: DataFrame) -> DataFrame:
    """Columns that could be the target, best first.

    A column whose rarest value has 10 rows has at most rows / 10 distinct values.
    Columns estimated at over twice that many are measurements or ids: they cannot
    pass and are not shuffled.
    """
    columns = [c for c in df.columns if c not in S.ID_COLUMNS]
    probe = df.agg(F.count("*").alias("_n"), *[
        F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), 12)), F.lit(0)).alias(c)
        for c in columns
    ]).first()
    ceiling = 2 * probe["_n"] / S.TARGET_MIN_CLASS_ROWS
    plausible = [c for c in columns if S.TARGET_MIN_CLASSES <= probe[c] * 1.2 and probe[c] <= ceiling]
    scores = []
    for f in df.schema:
        named = any(k in f.name.lower() for k in S.TARGET_NAME_KEYWORDS)
        kind = 3.0 if isinstance(f.dataType, T.StringType) else (
            1.0 if isinstance(f.dataType, T.BooleanType) else 0.0)
        scores.append((f.name, 1.0 + (10.0 if named else 0.0) + kind))
    scored = literal_table(df.sparkSession, scores, "column string, score double")
    if not plausible:
        return scored.limit(0).select("column", F.lit(0).cast("long").alias("n_unique"), "score")
    return (
        value_frequency(df, plausible, probe["_n"])
        .filter((F.col("n_unique") >= S.TARGET_MIN_CLASSES)
                & (F.col("unique_fraction") <= S.TARGET_MAX_UNIQUE_FRACTION)
                & (F.col("min_class_rows") >= S.TARGET_MIN_CLASS_ROWS))
        .join(scored, "column")
        .select("column", "n_unique", "unique_fraction", "min_class_rows", "score")
        .orderBy(F.desc("score"), "column")
    )


def discover_target(df: DataFrame) -> str:
    """Name of the best target candidate; an error when there is none."""
    best = target_candidates(df).limit(1).collect()
    if not best:
        raise ValueError("no column qualifies as a target")
    return best[0]["column"]


def quality_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_null, n_nan, n_infinite, all_null) in one pass."""
    counts = df.agg(F.count("*").alias("_n"), *[
        agg for c in columns for agg in (
            F.count_if(F.col(c).isNull()).alias(f"{c}__null"),
            F.count_if(F.isnan(F.col(c).cast("double"))).alias(f"{c}__nan"),
            F.count_if(F.abs(F.col(c).cast("double")) == float("inf")).alias(f"{c}__inf"),
        )
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("feature"), F.col(f"{c}__null").alias("n_null"),
            F.col(f"{c}__nan").alias("n_nan"), F.col(f"{c}__inf").alias("n_infinite"),
            (F.col(f"{c}__null") == F.col("_n")).alias("all_null"),
        ) for c in columns
    ])))


def running_best(trials: DataFrame, order: str, value: str, plain_rows: int | None = None) -> DataFrame:
    """Adds ``best`` = largest value so far in ``order`` (A29); ``order`` must be unique."""
    keyed = trials.withColumn("_all", F.lit(0))
    return running_max(keyed, ["_all"], order, {"best": value}, plain_rows).drop("_all")


def boxplot(df: DataFrame, value: str, by: str, percentile_rows: int = PERCENTILE_ROWS) -> DataFrame:
    """(class, q1, median, q3, low_whisker, high_whisker, n_outliers) with 1.5 IQR whiskers."""
    rows = df.select(by, F.col(value).cast("double").alias(value)).dropna()
    q = quantiles(rows, [value], [0.25, 0.5, 0.75], by=[by], percentile_rows=percentile_rows)
    boxes = checked_broadcast(q.groupBy(by).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
        for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
    ]))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.join(boxes, by).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("low_whisker"),
        F.max(F.when(inside, F.col(value))).alias("high_whisker"),
        F.count_if(~inside).alias("n_outliers"),
    )
