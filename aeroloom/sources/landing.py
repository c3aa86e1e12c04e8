"""Landed Parquet and staging tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aeroloom import vocab
from aeroloom.functions.times import as_date


def _landing_schema(source: str, schema) -> T.StructType:
    fields = T.StructType.fromDDL(schema or vocab.WIDE_SCHEMAS[source]) if not isinstance(schema, T.StructType) else schema
    extra = T.StructType.fromDDL("source string, agg string, dt date")
    return T.StructType([*fields.fields, *extra.fields])


def scan_landing(spark: SparkSession, root: str, source: str, agg: str = "raw", start=None, end=None,
                 schema=None) -> DataFrame:
    """Landed rows of one source and aggregation, within the days when given.

    The explicit schema makes days whose column was all null readable; source, agg and day are partition
    columns, so other files are never opened.  A root that does not exist yet is an empty result.
    """
    full = _landing_schema(source, schema)
    try:
        df = spark.read.schema(full).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    df = df.filter((F.col("source") == source) & (F.col("agg") == agg))
    if start is not None:
        df = df.filter(F.col("dt") >= F.lit(as_date(start)))
    if end is not None:
        df = df.filter(F.col("dt") <= F.lit(as_date(end)))
    return df


def load_day(spark: SparkSession, root: str, source: str, d, agg: str = "raw", schema=None) -> DataFrame:
    """One landed day; a missing day is empty."""
    return scan_landing(spark, root, source, agg, d, d, schema)


def filter_by_path_date(df: DataFrame, d) -> DataFrame:
    """Rows whose file lies in the day's folder, for trees without typed partitions."""
    return df.filter(F.col("_metadata.file_path").rlike(f"/dt={as_date(d).isoformat()}/"))


def staging_name(source: str, d) -> str:
    return f"staging_{source.lower()}_{as_date(d):%Y%m%d}"


def resolve_staging(spark: SparkSession, tables=None, prefix: str | None = None, suffix: str | None = None,
                    sources=None, dates=None, exclude=()) -> DataFrame:
    """Union of the selected staging tables: one name, a list, a prefix and suffix, or sources by dates.

    Named tables must exist; dated tables that do not are skipped.
    """
    known = {t.name for t in spark.catalog.listTables()}
    if tables is not None:
        names = [tables] if isinstance(tables, str) else list(tables)
        absent = [n for n in names if n not in known]
        if absent:
            raise ValueError(f"no such staging table: {absent}")
    elif prefix is not None:
        names = sorted(n for n in known if n.startswith(prefix) and n.endswith(suffix or "") and n not in set(exclude))
    else:
        wanted = [staging_name(s, d) for d in dates for s in sources]
        names = [n for n in wanted if n in known]
    if not names:
        raise ValueError("no staging table selected")
    columns = ["timestamp", "deployment_fk", "metric_name", "value"]
    return reduce(DataFrame.unionByName, [spark.table(n).select(*columns) for n in names])


def scan_staging(spark: SparkSession, path: str, sources=None, start=None, end=None, versions: bool = False) -> DataFrame:
    """Staging rows of the partitioned staging dataset; with ``versions``, the number of their load and their place in it."""
    numbers = "load bigint, seq bigint, " if versions else ""
    df = spark.read.schema(f"timestamp timestamp, deployment_fk string, metric_name string, value double, {numbers}"
                           "source string, dt date").parquet(path)
    if sources is not None:
        df = df.filter(F.col("source").isin(list(sources)))
    if start is not None:
        df = df.filter(F.col("dt").between(F.lit(as_date(start)), F.lit(as_date(end or start))))
    return df


def day_range(start, end) -> list[dt.date]:
    first, last = as_date(start), as_date(end)
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
