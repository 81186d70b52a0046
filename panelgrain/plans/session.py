"""Session defaults.  On a cluster the submitted configuration wins."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "panelgrain") -> SparkSession:
    """A local session for tests and benchmarks."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call sites in error messages cost several calls into the JVM per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, prefix: str) -> str:
    """A new folder for a stream's sink and checkpoints.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``; only
    where none is named, as in tests, is a new temporary folder made.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="run-")
    return f"{base}/{prefix}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "settled"))
    return df.checkpoint()
