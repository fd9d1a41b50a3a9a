"""Small sides of joins: literal tables, and results proven to be small."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A side is broadcast only when it has at most this many rows.
SMALL_ROWS = 200_000


def _local_relation(spark: SparkSession, rows: Iterable[Sequence], struct: T.StructType) -> DataFrame:
    columns = list(zip(*rows)) or [()] * len(struct)
    arrow = to_arrow_schema(struct)
    table = pa.Table.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, arrow)], schema=arrow
    )
    return spark.createDataFrame(table, schema=struct)


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Rows known to the driver as a local relation, whose exact size Catalyst sees."""
    return _local_relation(spark, rows, T._parse_datatype_string(schema))


def local_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` as a local relation if it has at most ``max_rows`` rows, else ``df``.

    Meant for statistics (one row per feature, class, bucket): evaluating them once
    here also keeps their plan from being repeated in every consumer.  The probe
    takes rows partition by partition and stops one row past the bound.
    """
    rows = df.take(max_rows + 1)
    return df if len(rows) > max_rows else _local_relation(df.sparkSession, rows, df.schema)


def checked_broadcast(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """A side of a join: ``df`` as a broadcast local relation if it is small, else ``df``."""
    small = local_if_small(df, max_rows)
    return df if small is df else F.broadcast(small)


def small_rows(df: DataFrame, max_rows: int = SMALL_ROWS) -> list:
    """Rows of a frame that must be small; refuses to fetch an unbounded one."""
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows on the driver")
    return rows


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "feature",
         value: str = "value") -> DataFrame:
    """Wide to long in one map-only step: ``keep`` columns, feature name, double value."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns
    ])
    return df.select(*keep, F.inline(pairs))


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """Column -> (non-null count, mean, min, max) in one pass, as driver numbers."""
    row = df.agg(*[
        f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(columns)
        for k, f in (("n", F.count), ("mean", F.avg), ("min", F.min), ("max", F.max))
    ]).first()
    return {c: tuple(row[f"{k}{i}"] for k in ("n", "mean", "min", "max")) for i, c in enumerate(columns)}


def column_sums(df: DataFrame, expressions: dict) -> dict:
    """Name -> sum of an expression over all rows, nulls skipped, in one pass.

    Plain sums only: unlike moment aggregates they stay in generated code by the hundred.
    """
    row = df.agg(*[F.sum(e.cast("double")).alias(f"s{i}") for i, e in enumerate(expressions.values())]).first()
    return dict(zip(expressions, row))


def div(a: Column, b: Column) -> Column:
    """a / b, null when b is 0 (division by zero raises under ANSI mode)."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def half_even(x: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding of array libraries."""
    scale = F.lit(float(10 ** digits))
    return F.rint(x.cast("double") * scale) / scale
