"""Shared pieces of the text operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with DuckDB SQL where SQL can say it."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null counts as empty."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words of a text as long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slots(df: DataFrame) -> int:
    """Task slots of the session."""
    return df.sparkSession.sparkContext.defaultParallelism


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sheltered(*helpers: str):
    """For a function of a DataFrame that adds helper columns of these names: columns of the input
    that have one of them (names compare without case) get another name inside and come out as they were."""
    def wrap(fn):
        @wraps(fn)
        def run(df: DataFrame, *args, **kwargs) -> DataFrame:
            reserved = {h.lower() for h in helpers}
            used, moved = reserved | {c.lower() for c in df.columns}, {}
            for c in df.columns:
                if c.lower() in reserved:
                    free = c
                    while free.lower() in used:
                        free += "_"
                    used.add(free.lower())
                    moved[c] = free
            if not moved:
                return fn(df, *args, **kwargs)
            named = [moved.get(a, a) if isinstance(a, str) else a for a in args]
            named_too = {k: moved.get(a, a) if isinstance(a, str) else a for k, a in kwargs.items()}
            return fn(df.withColumnsRenamed(moved), *named, **named_too).withColumnsRenamed({v: k for k, v in moved.items()})
        return run
    return wrap
