"""Fitted models and finished comparisons, kept in the shared folder by what they were made from.

An artefact is a folder, written once; a pointer named by its key is written after it.  Later
queries, sessions and clusters with the same ``spark.checkpoint.dir`` read it instead of fitting again.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tracklab.operators.small import literal_table
from tracklab.session import scratch_dir


def _root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/kept"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return os.path.join(tempfile.gettempdir(), f"tracklab-kept-{spark.sparkContext.applicationId}")


def files_print(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of names, lengths and times of all files below ``paths``."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(conf).listFiles(where, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()


def kept(spark: SparkSession, purpose: str, key: Sequence, make: Callable[[str], None]) -> str:
    """The folder of an artefact; ``make`` writes it where no earlier run has.

    Of two runs that make it at a time the first pointer stays; both folders hold the same.
    """
    name = hashlib.sha256(json.dumps([str(k) for k in key]).encode()).hexdigest()[:32]
    pointer = f"{_root(spark)}/{purpose}-{name}"
    try:
        known = spark.read.schema("folder string").parquet(pointer).head()
    except AnalysisException:
        known = None
    if known:
        return known["folder"]
    folder = scratch_dir(spark, purpose)
    make(folder)
    literal_table(spark, [(folder,)], "folder string").coalesce(1).write.mode("ignore").parquet(pointer)
    return folder
