"""The daily batch: landing -> long fact -> rollups -> locations, and backfills over a range of days.

A table is a folder below ``warehouse``, partitioned by ``dt``.  Every step replaces exactly the days it
computes, so any day or range can be run again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from aeroloom import vocab
from aeroloom.functions import air
from aeroloom.functions.times import as_date, normalize_time
from aeroloom.operators import locations, normalize, rollups
from aeroloom.sinks import tables
from aeroloom.sources import landing

LONG_SCHEMA = ("timestamp timestamp, native_sensor_id string, metric_name string, value double, latitude double, "
               "longitude double, geog struct<longitude: double, latitude: double>, dt date")
_STATS = ("native_sensor_id string, metric_name string, latitude double, longitude double, "
          "geog struct<longitude: double, latitude: double>, avg_value double, min_value double, max_value double, "
          "samples bigint, dt date")
HOURLY_SCHEMA, DAILY_SCHEMA = f"hour_ts timestamp, {_STATS}", f"day_ts timestamp, {_STATS}"


def raw_path(warehouse: str, source: str) -> str:
    return f"{warehouse}/{source.lower()}_raw_materialized"


def rejected_path(warehouse: str, source: str) -> str:
    return f"{warehouse}/{source.lower()}_raw_rejected"


def days_of(spark: SparkSession, path: str, schema: str, start, end) -> DataFrame:
    """Table rows of a range of days, pruned by partition; empty where the table does not exist yet."""
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schema)
    return tables.read_table(spark, path, schema).filter(
        F.col("dt").between(F.lit(as_date(start)), F.lit(as_date(end))))


def _wide_schema(source: str) -> str:
    return vocab.WIDE_SCHEMAS[source] + ", dt date"


def materialize_range(spark: SparkSession, landing_root: str, warehouse: str, start, end, sources=("WU", "TSI"),
                      fallback_root: str | None = None) -> None:
    """Copy landed days to the raw tables with one canonical ``ts``.

    Days absent from the landing tree are taken from ``fallback_root``.  A row lands in the day of its own time.  What has
    no time, or one outside the range, goes to `rejected_path`, by the day of the folder that it came from.
    """
    for source in sources:
        rows = landing.scan_landing(spark, landing_root, source, "raw", start, end)
        if fallback_root:
            have = rows.select("dt").distinct()
            spare = landing.scan_landing(spark, fallback_root, source, "raw", start, end)
            rows = rows.unionByName(spare.join(have, "dt", "left_anti"))
        # The raw time columns collapse to ts.
        timed = normalize_time(rows.drop("ts")).withColumn("own", F.to_date("ts"))
        inside = F.coalesce(F.col("own").between(F.lit(as_date(start)), F.lit(as_date(end))), F.lit(False))
        fixed = timed.filter(inside).withColumns({"timestamp": F.col("ts"), "dt": F.col("own")})
        out = normalize.conform(fixed, _wide_schema(source))
        tables.replace_window(out, raw_path(warehouse, source), start, end, ("native_sensor_id",))
        left = normalize.conform(timed.filter(~inside).withColumn("timestamp", F.col("ts")), _wide_schema(source))
        tables.replace_window(left, rejected_path(warehouse, source), start, end, ("native_sensor_id",))


def raw_days(spark: SparkSession, warehouse: str, start, end) -> dict[str, DataFrame]:
    """Raw wide rows of the days, per source."""
    return {s: days_of(spark, raw_path(warehouse, s), _wide_schema(s), start, end) for s in ("WU", "TSI")}


def long_fact(spark: SparkSession, warehouse: str, start, end, metrics=None) -> DataFrame:
    """Long rows of both sources for the days, from the raw tables."""
    parts = [normalize.source_long(raw, s, metrics) for s, raw in raw_days(spark, warehouse, start, end).items()]
    return normalize.union_all(*parts).withColumn("dt", F.to_date("timestamp"))


def run(spark: SparkSession, warehouse: str, proc_date, end=None, window_days: int = 7, location_days: int = 90,
        rollup_from: str = "long") -> None:
    """Long fact and hourly rollup of the days ``proc_date``..``end``, the daily rollup of the trailing window
    and the canonical locations as of the last day.

    A range is one job per table, not one per day.  ``rollup_from='raw'`` aggregates the wide rows instead of
    the long fact: the same numbers for about half the work per row, at some fixed cost per run, so it pays
    off on large days.
    """
    first, last = as_date(proc_date), as_date(end or proc_date)
    long_path = f"{warehouse}/sensor_readings_long"
    # The point of a row follows from its coordinates.
    point = {"geog": air.geo_point(F.col("latitude"), F.col("longitude"))}
    tables.replace_window(long_fact(spark, warehouse, first, last), long_path, first, last, made=point)

    start = first - dt.timedelta(days=window_days - 1)

    def grouped(grain: str, a, b) -> DataFrame:
        if rollup_from == "raw":
            return rollups.rollup_sources(raw_days(spark, warehouse, a, b), grain)
        # An hour of a sensor and metric has a few rows; a day has enough of them for a map-side aggregate.  Hours dealt for the
        # aggregate are dealt for the table as well.
        return rollups.rollup(days_of(spark, long_path, LONG_SCHEMA, a, b).drop("dt"), grain, dealt=grain == "hour")

    hourly = grouped("hour", first, last)
    in_order = "dt" in hourly.columns
    tables.replace_window(hourly if in_order else hourly.withColumn("dt", F.to_date("hour_ts")), f"{warehouse}/sensor_readings_hourly",
                          first, last, made=point, dealt=in_order)
    daily = grouped("day", start, last).withColumn("dt", F.to_date("day_ts"))
    tables.replace_window(daily, f"{warehouse}/sensor_readings_daily", start, last, made=point)

    back = last - dt.timedelta(days=location_days - 1)
    raw = raw_days(spark, warehouse, back, last)
    canonical = locations.canonical_location(raw["WU"], raw["TSI"], last, location_days)
    # One snapshot per as-of day is kept, so that the latest position per sensor is a real choice.
    tables.replace_window(canonical.withColumn("dt", F.col("as_of_date")),
                          f"{warehouse}/sensor_canonical_location", last, last, ("native_sensor_id",))


def backfill(spark: SparkSession, landing_root: str, warehouse: str, start, end, sources=("WU", "TSI")) -> None:
    """Materialise and transform a whole range."""
    materialize_range(spark, landing_root, warehouse, start, end, sources)
    run(spark, warehouse, start, end)


def merge_range(spark: SparkSession, target: str, staging: str, start, end, sources=("wu", "tsi"),
                only_if_changed: bool = False) -> None:
    """Merge the staged days of a range into the star fact in one pass.

    Of a key's copies the one of the last load wins, and of one load the last by its ``seq`` (see `write_staging`); where
    neither tells, the larger value."""
    staged = landing.scan_staging(spark, staging, sources, start, end, versions=True)
    once = staged.filter(F.col("value").isNotNull()).groupBy("timestamp", "deployment_fk", "metric_name").agg(
        F.max(F.struct("load", "seq", "value")).alias("last")).select("timestamp", "deployment_fk", "metric_name", "last.value")
    tables.merge_into(spark, target, once, ["timestamp", "deployment_fk", "metric_name"], only_if_changed=only_if_changed)
