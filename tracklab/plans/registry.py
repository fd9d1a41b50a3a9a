"""Name -> query and name -> oracle SQL, filled by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def r6(column: Column) -> Column:
    """Six digits, for comparing results whose last bits depend on summation order."""
    return F.round(column, 6)


def rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    """Where exact decimal ties occur at six digits, ``digits`` is one more."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the DuckDB SQL giving the same rows."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add
