"""Session helpers.

The library never creates a session on its own: every operator takes a
DataFrame (or a SparkSession) from the caller.  ``local_session`` exists for
tests and ``bench.py``; on a cluster the caller builds the session.
"""

from __future__ import annotations

import hashlib
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app_name: str = "quarry") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The folder comes from the session (``spark.checkpoint.dir`` or a
    directory already set on the context).  A cluster without one is an
    error: a folder of the driver's machine would not be seen by the
    executors.  Only a ``local`` master, one machine, gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder, for files a query writes."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "quarry", *parts])


def clear_shared(spark: SparkSession, *parts: str) -> None:
    """Delete what the library wrote below the shared folder (all of it, or
    one part such as ``"fixtures"``).  DataFrames that still read those files
    fail afterwards, so call it when a run's results have been used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, *parts))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path, True)


def table_version(spark: SparkSession, path: str) -> str:
    """A digest of a table's files (names, sizes, times of change): data
    derived from a table is kept under it and never outlives a change."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [(f.getPath().toString(), f.getLen(), f.getModificationTime())
             for f in (fs.globStatus(where) or []) for f in (fs.listStatus(f.getPath())
                                                             if f.isDirectory() else [f])]
    return hashlib.sha1(repr(sorted(files)).encode()).hexdigest()[:16]


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to the end (Spark's success marker)."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)
