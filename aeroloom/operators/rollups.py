"""Hourly and daily rollups, resampling and aggregate building blocks.

All aggregates here keep fixed-width buffers, so Spark hash-aggregates them map-side before the shuffle and
one hot sensor or metric costs no more than its number of result rows.  `rollup_with_row_id`, and `rollup` when asked, aggregate after the
shuffle instead, the latter over sorted rows.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from aeroloom import vocab
from aeroloom.functions import air
from aeroloom.functions.numbers import numeric
from aeroloom.functions.times import as_date, bin_start, days_between, interval_seconds
from aeroloom.operators.normalize import NAME_PARTS, float_coords, has_reading, named, numbered, union_all

GRAINS = {"hour": "hour_ts", "day": "day_ts"}


def earliest_first(order: str, lat: str, lon: str) -> Column:
    """A number that orders complete points by time, and those of one time by a hash of the point; null if incomplete.

    Its width is fixed, as a struct's is not, so aggregates that order by it are hash aggregates.
    """
    micros = F.unix_micros(F.col(order).cast("timestamp")).cast("decimal(17,0)")
    point = F.xxhash64(lat, lon).cast("decimal(20,0)")
    key = (micros * F.lit(Decimal(10 ** 20))).cast("decimal(38,0)") + point
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), key.cast("decimal(38,0)"))


def earliest_within(order: str, start: str, lat: str, lon: str) -> Column:
    """As `earliest_first`, for points of one hour or day that begins at ``start``: a bigint of 37 bits of microseconds and the upper 26
    bits of the hash, half as wide and without decimal arithmetic.

    Points of one time whose hashes agree in those bits count as equal; of them both aggregates still take the same row.
    """
    since = F.unix_micros(F.col(order).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))
    point = F.shiftright(F.xxhash64(lat, lon), 38) + F.lit(1 << 25)
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.shiftleft(since, 26) + point)


def representative(lat: str, lon: str, order: str) -> tuple[Column, Column]:
    """The earliest complete point of a group as (latitude, longitude) aggregates.

    Both aggregates follow the same ordering, time and then the point itself, so the two coordinates come from one row
    and a retried task gives the same one.
    """
    when = earliest_first(order, lat, lon)
    return F.min_by(lat, when).alias("latitude"), F.min_by(lon, when).alias("longitude")


def _stats() -> list[Column]:
    return [F.try_divide(F.sum("value"), F.count("value").cast("double")).alias("avg_value"), F.min("value").alias("min_value"),
            F.max("value").alias("max_value"), F.count(F.lit(1)).alias("samples")]


def rollup(long_df: DataFrame, grain: str, dealt: bool = False) -> DataFrame:
    """Average, minimum, maximum and count per (hour or day, sensor, metric), with one location.

    ``dealt`` is for groups of few rows, of which a map-side aggregate would hold a row per group of its split, however large that is.
    The rows are sent out by ranges of day, sensor and hour, sorted, and aggregated as they come, which holds no groups at all; the result
    has its day as ``dt`` and lies in order of day, sensor and metric, as a table of days wants it.
    """
    out = GRAINS[grain]
    start, first = F.date_trunc(grain, "timestamp"), earliest_within("timestamp", out, "latitude", "longitude")
    if dealt:
        # Rows go out without what follows from their time.  The point as one struct, whose width is not fixed, has Spark aggregate
        # sorted rows.
        light = numbered(long_df.select("native_sensor_id", "latitude", "longitude", "timestamp", "metric_name", "value"))
        sent = light.repartitionByRange(F.to_date(start), "native_sensor_id", start)
        rows = sent.withColumns({out: start, "dt": F.to_date(start)}).withColumn("first", first)
        grouped = named(rows.groupBy("dt", "native_sensor_id", *NAME_PARTS, out)
                        .agg(F.min_by(F.struct("latitude", "longitude"), "first").alias("point"), *_stats())
                        .withColumns({"latitude": F.col("point.latitude"), "longitude": F.col("point.longitude")}))
    else:
        rows = long_df.withColumn(out, start).withColumn("first", first)
        grouped = rows.groupBy(out, "native_sensor_id", "metric_name").agg(
            F.min_by("latitude", "first").alias("latitude"), F.min_by("longitude", "first").alias("longitude"), *_stats())
    return grouped.select(
        out, "native_sensor_id", "metric_name", "latitude", "longitude",
        air.geo_point(F.col("latitude"), F.col("longitude")).alias("geog"),
        "avg_value", "min_value", "max_value", "samples", *["dt"] * dealt)


#: Bins that one array of `resample_mean` holds.
STRETCH = 65_536
# Metrics aggregated side by side: eight buffers each keep a pass under Spark's limit of 100 generated fields.
METRICS_PER_PASS = 10


def rollup_wide(df: DataFrame, source: str, grain: str, metrics=None, ts: str = "ts") -> DataFrame:
    """The same rollup straight from one source's wide rows.

    Wide rows are aggregated first and only the groups are unpivoted, so a row is hashed once per pass instead
    of once per metric, and neither the long fact nor its expansion is read.  A pass scans its own metrics.
    """
    wanted = [m for m in vocab.METRICS[source] if m in df.columns and (metrics is None or m in metrics)]
    return union_all(*[_rollup_pass(df, source, grain, wanted[i:i + METRICS_PER_PASS], ts)
                       for i in range(0, max(len(wanted), 1), METRICS_PER_PASS)])


def _rollup_pass(df: DataFrame, source: str, grain: str, wanted, ts: str) -> DataFrame:
    out = GRAINS[grain]
    pairs = vocab.COORDS[source]
    (lat, _), (lon, _) = pairs
    types = {f.name: f.dataType for f in df.schema}
    wide = float_coords(df, pairs).filter(F.col(ts).isNotNull()).select(
        F.date_trunc(grain, ts).alias(out), "native_sensor_id", F.col(ts).alias("at"), F.col(lat).alias("lat"),
        F.col(lon).alias("lon"), *[numeric(F.col(m), types[m]).alias(f"v {m}") for m in wanted])
    wide = wide.withColumn("first", earliest_within("at", out, "lat", "lon")).drop("at")
    aggs = []
    for m in wanted:
        v = F.col(f"`v {m}`")
        seen = F.when(v.isNotNull(), F.col("first"))
        aggs += [F.min_by("lat", seen).alias(f"lat {m}"), F.min_by("lon", seen).alias(f"lon {m}"), F.sum(v).alias(f"sum {m}"),
                 F.min(v).alias(f"min {m}"), F.max(v).alias(f"max {m}"), F.count(v).alias(f"n {m}")]
    # Choosing by position, unlike `inline`, lets Spark drop the aggregates of columns that are not asked for.
    def pick(value) -> Column:
        return reduce(lambda made, i: made.when(F.col("nth") == i, value(wanted[i])), range(1, len(wanted)), F.when(F.col("nth") == 0, value(wanted[0])))

    grouped = wide.groupBy(out, "native_sensor_id").agg(*aggs).select("*", F.explode(F.array(*[F.lit(i) for i in range(len(wanted))])).alias("nth")).select(
        out, "native_sensor_id", pick(F.lit).alias("metric_name"), pick(lambda m: F.col(f"`lat {m}`")).alias("latitude"),
        pick(lambda m: F.col(f"`lon {m}`")).alias("longitude"),
        pick(lambda m: F.try_divide(F.col(f"`sum {m}`"), F.col(f"`n {m}`").cast("double"))).alias("avg_value"),
        pick(lambda m: F.col(f"`min {m}`")).alias("min_value"), pick(lambda m: F.col(f"`max {m}`")).alias("max_value"), pick(lambda m: F.col(f"`n {m}`")).alias("samples"))
    return grouped.filter(F.col("samples") > 0).select(
        out, "native_sensor_id", "metric_name", "latitude", "longitude",
        air.geo_point(F.col("latitude"), F.col("longitude")).alias("geog"),
        "avg_value", "min_value", "max_value", "samples")


def rollup_sources(wide: dict[str, DataFrame], grain: str, metrics=None, ts: str = "ts") -> DataFrame:
    """Rollup of all sources from their wide rows.

    A sensor id belongs to one source; a metric both sources report under one id would give two rows.  A source without
    any of the ``metrics`` is not read; one at least must have some.
    """
    having = {s: df for s, df in wide.items() if any(m in df.columns and (metrics is None or m in metrics) for m in vocab.METRICS[s])}
    return union_all(*[rollup_wide(df, source, grain, metrics, ts) for source, df in having.items()])


def observed_sensors(wide: dict[str, DataFrame]) -> DataFrame:
    """Distinct sensors with at least one reading, without unpivoting."""
    parts = [has_reading(df, vocab.METRICS[s]).select("native_sensor_id") for s, df in wide.items()]
    return union_all(*parts).distinct()


def hourly_rollup(long_df: DataFrame, d=None, end=None) -> DataFrame:
    """Hourly rollup of one day, of the days ``d``..``end``, or of everything."""
    if d is not None:
        long_df = long_df.filter(days_between(long_df, "timestamp", d, end or d))
    return rollup(long_df, "hour")


def daily_rollup(long_df: DataFrame, proc_date=None, days: int = 7) -> DataFrame:
    """Daily rollup of the ``days`` days that end at ``proc_date``, straight from the long fact."""
    if proc_date is not None:
        start = as_date(proc_date) - dt.timedelta(days=days - 1)
        long_df = long_df.filter(days_between(long_df, "timestamp", start, proc_date))
    return rollup(long_df, "day")


def rollup_with_row_id(long_df: DataFrame, grain: str, algo: str = "xxhash64") -> DataFrame:
    """Rollup keyed by a fingerprint and a date column, without location."""
    out = GRAINS[grain]
    text = F.date_format(out, "yyyy-MM-dd HH:mm:ss")
    # Few rows of a split share a key, and a map-side aggregate that outgrows its task is spilled, which is more than the rows themselves.
    # All rows of one hour and sensor, or of one day, sensor and metric, meet in one task, which holds a row per group; the number of
    # tasks is given, since Spark would join them by their bytes, which are few for their groups.
    spark = long_df.sparkSession
    rows = numbered(long_df.withColumn(out, F.date_trunc(grain, "timestamp")).select(out, "native_sensor_id", "metric_name", "value"))
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), out, "native_sensor_id", *(NAME_PARTS if grain == "day" else ()))
    return named(dealt.groupBy(out, "native_sensor_id", *NAME_PARTS).agg(*_stats())).select(
        out, F.to_date(out).alias(f"{grain}_date"), "native_sensor_id", "metric_name",
        "avg_value", "min_value", "max_value", "samples",
        air.row_id(text, "native_sensor_id", "metric_name", algo=algo).alias("row_id"))


def resample_mean(df: DataFrame, key: str, ts: str, interval: str, exclude=()) -> DataFrame:
    """Mean of the numeric columns per key and interval; empty bins between a key's first and last are kept."""
    seconds = interval_seconds(interval)
    numeric = [f.name for f in df.schema
               if isinstance(f.dataType, T.NumericType) and f.name not in {key, ts, *exclude}]
    binned = (df.filter(F.col(ts).isNotNull() & F.col(key).isNotNull())
              .withColumn("bin", bin_start(F.col(ts), seconds))
              .groupBy(key, "bin").agg(*[F.avg(c).alias(c) for c in numeric]))
    # The spine of a key is as long as its timeline, whatever its number of rows: it is dealt out in stretches of bins, so
    # neither an array nor a task holds all of it.
    nth = F.floor(F.unix_seconds("bin") / seconds)
    spans = binned.groupBy(key).agg(F.min(nth).alias("low"), F.max(nth).alias("high"))
    stretches = spans.withColumn("from", F.explode(F.expr(f"sequence(low, high, {STRETCH}L)"))).repartition(key, "from")
    spine = stretches.select(key, F.explode(F.sequence("from", F.least(F.col("from") + STRETCH - 1, F.col("high")))).alias("nth"))
    spine = spine.select(key, F.timestamp_seconds(F.col("nth") * seconds).alias("bin"))
    return spine.join(binned, [key, "bin"], "left").select(key, F.col("bin").alias(ts), *numeric)


def first_seen(df: DataFrame, ts: str = "timestamp", key: str = "native_sensor_id") -> DataFrame:
    """First reading date per sensor."""
    return (df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
            .groupBy(key).agg(F.to_date(F.min(ts)).alias("first_date")))


def rows_per_day(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    if start is not None:
        df = df.filter(days_between(df, ts, start, end))
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("row_count"))


def table_summaries(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """First day, last day, number of days and rows per named (frame, time column)."""
    out = None
    for name, (df, ts) in frames.items():
        # Counting days first keeps the distinct count to one row per day.
        part = rows_per_day(df, ts).agg(
            F.min("date").alias("min_date"), F.max("date").alias("max_date"),
            F.count("date").alias("days"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"))
        part = part.select(F.lit(name).alias("table_name"), *part.columns)
        out = part if out is None else out.unionByName(part)
    return out


def freshness_counts(frames: dict[str, DataFrame], since, ts: str = "timestamp") -> DataFrame:
    """Latest time and row count since a day, per source."""
    out = None
    for source, df in frames.items():
        part = (df.filter(F.col(ts) >= F.lit(as_date(since).isoformat()).cast(df.schema[ts].dataType))
                .agg(F.max(ts).alias("latest_ts"), F.count(F.lit(1)).alias("row_count"))
                .select(F.lit(source).alias("source"), "latest_ts", "row_count"))
        out = part if out is None else out.unionByName(part)
    return out


def collection_stats(log: DataFrame, since) -> DataFrame:
    """Records, errors and mean duration per day and source of the collection log."""
    return (log.filter(F.col("collection_date") >= F.lit(str(since)).cast("timestamp"))
            .groupBy(F.to_date("collection_date").alias("collection_day"), "source")
            .agg(F.sum("records_collected").alias("total_records"), F.sum("errors_count").alias("total_errors"),
                 F.avg("duration_seconds").alias("avg_duration")))


def dedupe_last(df: DataFrame, keys, seq: str, value: str | None = "value") -> DataFrame:
    """One row per key: the last by ``seq`` whose ``value`` is not null.

    Copies of one key are folded map-side (``max_by`` per column), so a key copied millions of times
    never gathers in one task.  ``seq`` must be unique within a key.
    """
    rows = df.filter(F.col(value).isNotNull()) if value else df
    others = [c for c in df.columns if c not in set(keys)]
    # max_by skips rows with a null ordering only; the value itself may be null.
    return rows.groupBy(*keys).agg(*[F.max_by(c, seq).alias(c) for c in others]).select(df.columns)


def distinct_of(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols).distinct()


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null count and, for numeric and time columns, the range.

    One aggregate row over the table, then turned to one row per column.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema):
        col = F.col(f"`{f.name}`")
        aggs.append(F.count(col).alias(f"n{i}"))
        if isinstance(f.dataType, T.NumericType):
            aggs += [F.min(col).cast("double").alias(f"min{i}"), F.max(col).cast("double").alias(f"max{i}"),
                     F.avg(col).cast("double").alias(f"mean{i}")]
        elif "time" in f.name.lower() or isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            parsed = F.try_to_timestamp(col) if isinstance(f.dataType, T.StringType) else col.try_cast("timestamp")
            aggs += [F.min(parsed).alias(f"from{i}"), F.max(parsed).alias(f"to{i}")]
    row = df.agg(*aggs)
    have = set(row.columns)

    def pick(name: str, kind: str, alias: str) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast(kind).alias(alias)

    entries = [F.struct(
        F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
        F.col("rows").alias("row_count"), F.col(f"n{i}").alias("non_null"),
        pick(f"min{i}", "double", "min_value"), pick(f"max{i}", "double", "max_value"),
        pick(f"mean{i}", "double", "mean_value"),
        pick(f"from{i}", "timestamp", "time_from"), pick(f"to{i}", "timestamp", "time_to"),
    ) for i, f in enumerate(df.schema)]
    return row.select(F.inline(F.array(*entries)))
