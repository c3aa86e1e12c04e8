"""Binary files in the shared folder, written and read inside tasks; and rows dealt in ascending order."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from aeroloom.session import scratch_path


def filesystem(uri: str):
    """File system and path of a folder or file; any scheme that Arrow knows, a plain path is local."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def committed(uri: str) -> Iterator:
    """A file to write; it appears under its name when complete, so a task that is lost or runs twice does no harm."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        yield out
    fs.move(part, path)


def read_at(uri: str):
    """The file opened for reading at any position."""
    fs, path = filesystem(uri)
    return fs.open_input_file(path)


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return scratch_path(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: fixes them and cuts their lineage."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table of `written` that is no longer read; what was made of it must be written too."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files behind tables that are written.

    It does so when the driver collects its garbage, which one with much free memory may not do for a long time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bounds(df: DataFrame, key: str, n: int, error: float = 0.01) -> list[int]:
    """At most ``n`` - 1 ascending cut points that split the rows about evenly by ``key``."""
    error = min(error, 0.25 / n)
    cuts = df.stat.approxQuantile(key, [i / n for i in range(1, n)], error) if n > 1 else []
    return sorted({int(c) for c in cuts})


def bucket_of(key: str, cuts: list[int]):
    """Number of the range that ``key`` falls into; rows without a key come first."""
    edges = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    # Position by a search over the literal edges: a sum would touch each edge for each row.
    return F.coalesce(F.expr("0") + F.size(F.filter(edges, lambda e: e <= F.col(key).cast("long"))), F.lit(0)).cast("int")
