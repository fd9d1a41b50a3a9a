"""Intermediate tables read by several later jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tracklab.operators.small import checked_broadcast
from tracklab.session import scratch_dir

# Bytes of an input per task slot beyond which it is read as it is split.
SPREAD_BYTES = 16 << 20
# Whether a query's shuffle files go when it ends, and the rows that Python gets at a time.
CLEAN_UP, BATCH_ROWS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings, given by the names of this module's constants, for what runs inside."""
    keys = {globals()[k]: str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df: DataFrame, purpose: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several passes follow over an aggregated or labelled table: the passes
    then read the table instead of repeating its plan, and a lost executor costs a
    re-read rather than a recomputation.  The shuffle files of the write go with it.
    ``batch_rows`` bounds the batches that Python gets, for rows of long texts or arrays.
    """
    path = scratch_dir(df.sparkSession, purpose)
    with settings(df.sparkSession, CLEAN_UP="true", **({"BATCH_ROWS": batch_rows} if batch_rows else {})):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Evaluate once: a broadcast local relation when small, else a staged table."""
    small = checked_broadcast(df)
    return small if small is not df else stage(df, purpose)


def spread(df: DataFrame) -> DataFrame:
    """Use all task slots for an input with fewer splits than slots.

    Large inputs pass through unchanged, by their bytes or as they have far more splits than slots:
    neither their shuffle nor the rows of a task would be bounded.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= slots * SPREAD_BYTES or df.rdd.getNumPartitions() >= 4 * slots:
        return df
    return df.repartition(slots)
