"""Session settings and the shared folder for files that outlive a task."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when a later step then needs its own shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # call sites for error messages cost several round trips per column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "zonalis", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_MARKED: set[str] = set()


def stage_root(spark: SparkSession) -> str:
    """Folder of this application below ``spark.checkpoint.dir``, or below the warehouse where that is not set.

    Every executor can reach either. The folder and all tables in it go when the application ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    context = spark.sparkContext
    folder = f"{shared.rstrip('/')}/stages-{context.applicationId}"
    if folder not in _MARKED:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _MARKED.add(folder)
    return folder


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`stage_root`."""
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
