"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, memory: str = "16g", app: str = "tracklab") -> SparkSession:
    """A single-JVM session, for tests and the benchmark only."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local
    master, where driver and executors are one process, may fall back to a
    machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="tracklab-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
