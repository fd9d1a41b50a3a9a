"""Row filters, casts, fills, lookups and winsorising."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklab import schema as S
from tracklab.operators.ordered import PERCENTILE_ROWS, quantiles
from tracklab.operators.small import checked_broadcast, half_even, literal_table, small_rows
from tracklab.sources.staging import stage
from tracklab.sources.tables import taxonomy


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing marker: NaN in floating columns becomes null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def drop_null_target(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.na.drop(subset=[target])


def cast_bool(df: DataFrame, column: str = S.BOOL_COLUMN) -> DataFrame:
    """Boolean column to 0/1; other types and absent columns are left alone."""
    if column in df.columns and isinstance(df.schema[column].dataType, T.BooleanType):
        return df.withColumn(column, F.col(column).cast("int"))
    return df


def drop_identifiers(df: DataFrame, columns: Sequence[str] = tuple(S.ID_COLUMNS)) -> DataFrame:
    return df.drop(*columns)


def features_and_target(df: DataFrame, target: str = S.TARGET, keep: Sequence[str] = ()) -> DataFrame:
    """Known features present in ``df``, in model order, and the target."""
    return df.select(*keep, *[c for c in S.FEATURES if c in df.columns], target)


def features_as_double(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All model inputs as doubles; fails when one is missing."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in S.FEATURES])


def numeric_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    """Columns of a numeric type; booleans are not numeric."""
    return [
        f.name for f in df.schema
        if isinstance(f.dataType, T.NumericType) and (among is None or f.name in among)
    ]


def available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist; pruning reaches the scan."""
    return df.select(*[c for c in wanted if c in df.columns])


def add_missing_features(df: DataFrame, value: float = 0) -> DataFrame:
    """Absent model inputs appended as a constant; nulls in present columns stay."""
    absent = [c for c in S.FEATURES if c not in df.columns]
    return df.withColumns({c: F.lit(value) for c in absent}) if absent else df


def fill_defaults(df: DataFrame) -> DataFrame:
    """Null cells and absent model inputs replaced by the per-feature default."""
    df = cast_bool(df)
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(default)) if c in df.columns else F.lit(default)
        for c, (_, _, default) in S.FEATURE_DOMAIN.items()
    })


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0, subset=list(columns))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null cells replaced by the exact median of their column."""
    medians = {r["feature"]: r["value"] for r in small_rows(quantiles(df, columns, [0.5]))}
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))) for c in columns
    })


def handle_row_cap(df: DataFrame, order: str, rows: int | None = None) -> DataFrame:
    """The first ``rows`` rows in ``order`` for an interactive upload; no cap unless asked for."""
    return df if rows is None else df.orderBy(order).limit(rows)


def domain_violations(df: DataFrame) -> DataFrame:
    """(feature, below, above) counts against the documented feature ranges, one pass."""
    df = cast_bool(df)
    present = [c for c in S.FEATURE_DOMAIN if c in df.columns]
    counts = df.agg(*[
        agg for c in present for agg in (
            F.count_if(F.col(c) < S.FEATURE_DOMAIN[c][0]).alias(f"{c}_below"),
            F.count_if(F.col(c) > S.FEATURE_DOMAIN[c][1]).alias(f"{c}_above"),
        )
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}_below").alias("below"),
                 F.col(f"{c}_above").alias("above")) for c in present
    ])))


def map_taxonomy(df: DataFrame, column: str = S.TARGET, out: str | None = None,
                 mapping: DataFrame | None = None) -> DataFrame:
    """Raw labels to classes; labels outside the mapping pass through unchanged."""
    mapping = taxonomy(df.sparkSession) if mapping is None else mapping
    joined = df.join(mapping, F.col(column) == F.col("raw_label"), "left")
    return joined.withColumn(out or column, F.coalesce("super_genre", column)).select(
        *df.columns, *([out] if out and out not in df.columns else [])
    )


def unmapped_labels(df: DataFrame, column: str = S.TARGET) -> DataFrame:
    """Distinct labels the taxonomy does not know."""
    labels = df.select(F.col(column).alias("raw_label")).filter("raw_label is not null").distinct()
    return labels.join(taxonomy(df.sparkSession), "raw_label", "left_anti").orderBy("raw_label")


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(label, code): 0..k-1 in alphabetical order of the labels as strings.

    The labels are sorted by ranges and staged; a label's code is its place in its range after
    the labels of the ranges before, so no task sees them all.
    """
    labels = df.select(F.col(column).cast("string").alias("label")).filter("label is not null").distinct()
    placed = stage(labels.repartitionByRange("label").sortWithinPartitions("label").withColumn("_at", F.monotonically_increasing_id()), "label-codes")
    part = F.shiftright("_at", 33)
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())
    before = list(accumulate((n for _, n in sizes), initial=0))
    starts = literal_table(df.sparkSession, [(p, n) for (p, _), n in zip(sizes, before)], "_part long, _before long")
    place = F.col("_before") + F.col("_at") - F.shiftleft("_part", 33)
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select("label", place.cast("int").alias("code"))


def encode_labels(df: DataFrame, column: str, out: str = "code", codes: DataFrame | None = None) -> DataFrame:
    """Attach integer codes; a label without a code is an error."""
    codes = checked_broadcast(label_codes(df, column) if codes is None else codes)
    code = F.when(F.col(column).isNull() | F.col("_code").isNotNull(), F.col("_code")).otherwise(
        F.raise_error(F.concat(F.lit("unseen label: "), F.col(column).cast("string")))
    )
    named = codes.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
    return df.join(named, F.col(column).cast("string") == F.col("_label"), "left").withColumn(
        out, code
    ).drop("_label", "_code")


def fences(df: DataFrame, columns: Sequence[str] = tuple(S.CLIP_FEATURES),
           multiplier: float = S.IQR_MULTIPLIER, percentile_rows: int = PERCENTILE_ROWS) -> DataFrame:
    """(feature, q1, q3, lower, upper): quartiles widened by ``multiplier`` IQRs."""
    present = [c for c in columns if c in df.columns]
    q = quantiles(df, present, [0.25, 0.75], percentile_rows=percentile_rows)
    wide = q.groupBy("feature").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    return wide.withColumn("lower", F.col("q1") - multiplier * iqr).withColumn(
        "upper", F.col("q3") + multiplier * iqr
    )


def fit_fences(df: DataFrame, **options) -> dict[str, tuple[float, float]]:
    """Fences on the driver: two numbers per clipped column."""
    return {r["feature"]: (r["lower"], r["upper"]) for r in small_rows(fences(df, **options))
            if r["lower"] is not None}


def clipped(column: Column, lower: float, upper: float) -> Column:
    """Clamp to [lower, upper]; null stays null."""
    x = column.cast("double")
    return F.when(x < lower, F.lit(lower)).when(x > upper, F.lit(upper)).otherwise(x)


def winsorise(df: DataFrame, limits: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Clip the clip columns to their fences; map-only once the fences are known."""
    limits = fit_fences(df) if limits is None else limits
    return df.withColumns({c: clipped(F.col(c), lo, hi) for c, (lo, hi) in limits.items()})


def clip_report(df: DataFrame, limits: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(feature, n_clipped, lower, upper) in one pass over the table."""
    limits = fit_fences(df) if limits is None else limits
    counts = df.agg(*[
        F.count_if((F.col(c).cast("double") < lo) | (F.col(c).cast("double") > hi)).alias(c)
        for c, (lo, hi) in limits.items()
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_clipped"),
                 half_even(F.lit(lo), 4).alias("lower"), half_even(F.lit(hi), 4).alias("upper"))
        for c, (lo, hi) in limits.items()
    ])))


def prepare(df: DataFrame, target: str = S.TARGET,
            limits: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Cleaning steps in order: null targets out, labels mapped, bool cast, clipped."""
    cleaned = cast_bool(map_taxonomy(drop_null_target(df, target), target))
    return winsorise(cleaned, limits)
