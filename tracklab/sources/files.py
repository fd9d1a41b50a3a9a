"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklab import schema as S
from tracklab.operators.cleaning import nan_to_null


def find_csv(spark: SparkSession, directory: str) -> str:
    """What holds the rows of a folder, on any Hadoop file system: its one CSV file, or the folder.

    The part files that a Spark job wrote are one table, so the path is then the folder's.
    Several other files may be unrelated: that is an error, and the caller names one.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(directory)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "*.csv")) if fs.exists(folder) else None
    paths = sorted(str(status.getPath()) for status in found or [])
    if not paths:
        raise FileNotFoundError(f"no CSV file in {directory}")
    if len(paths) == 1:
        return paths[0]
    if all(path.rpartition("/")[2].startswith("part-") for path in paths):
        return directory
    raise ValueError(f"{len(paths)} CSV files in {directory}; name one of {', '.join(paths[:5])}")


def read_tracks_csv(spark: SparkSession, path: str, indexed: bool = True) -> DataFrame:
    """The track file with its declared types; the leading index column is not data."""
    fields = list(S.TRACK_SCHEMA)
    if indexed:
        fields = [T.StructField(S.INDEX_COLUMN, T.LongType()), *fields]
    df = (
        spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", True)
        .option("quote", '"').option("escape", '"').csv(path)
    )
    return nan_to_null(df.drop(S.INDEX_COLUMN))


def read_upload_csv(spark: SparkSession, path: str) -> DataFrame:
    """A file with any columns: known columns get their declared type, others stay text.

    An index column is kept under the name ``Unnamed: 0``; a cell that does not parse is null.
    """
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    known = {f.name: f.dataType for f in S.TRACK_SCHEMA}
    return nan_to_null(raw.select(*[
        F.col(f"`{c}`").try_cast(known[c]).alias(c) if c in known
        else F.col(f"`{c}`").alias("Unnamed: 0" if i == 0 and c in ("", "_c0") else c)
        for i, c in enumerate(raw.columns)
    ]))


def load_tracks(spark: SparkSession, path: str | None = None, directory: str | None = None) -> DataFrame:
    """A CSV given by path, or all rows of a folder as ``find_csv`` sees it."""
    return read_tracks_csv(spark, path or find_csv(spark, directory))


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index; one file per task."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split, so that reading one split prunes the others."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, splits: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split").isin(list(splits)))


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report table as Parquet."""
    df.write.mode(mode).parquet(path)


def write_improvement_log(log: DataFrame, path: str) -> bool:
    """Append the log rows if there are any; nothing is written when the target is met."""
    if log.isEmpty():
        return False
    write_report(log, path, mode="append")
    return True
