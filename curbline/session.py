"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(name: str = "curbline", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Recording the call site of every Column doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for written intermediate tables.

    It lies in the folder the session names in ``spark.checkpoint.dir``, which
    every executor can reach. Only a session whose executors share this machine's
    disk, as in tests, may do without one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _own_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@functools.cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="curbline-")


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a written table, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
