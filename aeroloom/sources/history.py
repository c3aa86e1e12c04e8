"""CSV history with ragged columns."""

from __future__ import annotations

import os
from functools import reduce
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from aeroloom import vocab


def _list_csv(spark: SparkSession, folder: str) -> list[str]:
    """CSV files below a folder, by name; only the listing is read, not the content."""
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
                 .option("recursiveFileLookup", "true").load(folder).select("path"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r.path for r in files.collect())


def _name(path: str) -> str:
    return os.path.basename(unquote(urlparse(path).path))


HEAD_BYTES = 1 << 16


def _heads(spark: SparkSession, files: list[str]) -> list:
    """(path, head): the first line of every file that has one, from its first bytes, read in tasks.

    Places whose scheme Arrow does not know are read by Spark, through whole files.
    """
    from pyarrow import fs, lib

    try:
        for scheme in {f.split("://")[0] if "://" in f else f.split(":")[0] for f in files}:
            fs.FileSystem.from_uri(next(f for f in files if f.startswith(scheme)))
    except (lib.ArrowInvalid, OSError):
        lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
        return lines.filter("at = 0").groupBy("path").agg(F.first("value").alias("head")).collect()

    def first_lines(batches):
        for batch in batches:
            found = []
            for path in batch["path"]:
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_stream(place) as f:
                    head = b""
                    while b"\n" not in head and (more := f.read(HEAD_BYTES)):
                        head += more
                if head:
                    found.append((path, head.split(b"\n")[0].rstrip(b"\r").decode("utf-8", "replace")))
            yield pd.DataFrame(found, columns=["path", "head"])

    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(min(len(files), 64))
    return listed.mapInPandas(first_lines, "path string, head string").collect()


def read_csv_union(spark: SparkSession, files, **tags) -> DataFrame | None:
    """Rows of all files, columns united by name, with ``source_file`` and the given literals.

    Files are grouped by header, so the plan grows with the number of layouts rather than of files.  Values
    stay text; numeric parsing is the caller's.
    """
    files = list(files)
    if not files:
        return None
    # Headers may hold quoted names, so each distinct one is parsed by the reader.
    heads = _heads(spark, files)
    layouts: dict[tuple, list[str]] = {}
    columns_of: dict[str, tuple] = {}
    for r in sorted(heads):
        if r["head"] not in columns_of:
            columns_of[r["head"]] = tuple(spark.read.option("header", True).csv(r["path"]).columns)
        layouts.setdefault(columns_of[r["head"]], []).append(r["path"])
    parts = []
    for columns, group in layouts.items():
        schema = ", ".join(f"`{c}` string" for c in columns)
        part = spark.read.schema(schema).option("header", True).csv(group)
        part = part.withColumn("source_file", F.url_decode(F.col("_metadata.file_name")))
        parts.append(part.withColumns({k: F.lit(v) for k, v in tags.items()}) if tags else part)
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_history_csv(spark: SparkSession, root: str, first_only: bool = False) -> DataFrame:
    """History of all places below ``root``, with ``place``: master files, raw pulls per source and processed files.

    ``first_only`` reads the first place that has any file, in that order, and of the master files only the preferred
    ones, if there are any.
    """
    master = _list_csv(spark, f"{root}/master_data")
    preferred = [f for n in vocab.HISTORY_FILES for f in master if _name(f) == n]
    places = [("master_data", [(preferred or master if first_only else master, {})]),
              ("raw_pulls", [(_list_csv(spark, f"{root}/raw_pulls/{s}"), {"data_source": s}) for s in ("wu", "tsi")]),
              ("processed", [(_list_csv(spark, f"{root}/processed"), {})])]
    parts = []
    for place, groups in places:
        found = [read_csv_union(spark, files, place=place, **tags) for files, tags in groups]
        parts += [f for f in found if f is not None]
        if parts and first_only:
            break
    if not parts:
        raise ValueError(f"no CSV history under {root}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
