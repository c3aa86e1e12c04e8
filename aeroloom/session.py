"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: all times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where it is unset and all of Spark runs on this machine, a temporary folder that goes when the process ends; on a
    cluster that would be a folder of each machine by itself, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="aeroloom-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(current)
        return current
    # The context appends a run id to the folder it was given; scratch data may live beside it.
    return current.removeprefix("file:").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, visible to every executor."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is written inside removes its shuffle files when it ends, not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: fixes values that several branches of one plan must agree on."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: fixed, without lineage, and read by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
