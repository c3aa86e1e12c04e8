"""Ingest: payloads of a day or a range -> standard columns -> landing, staging and run log."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F

from aeroloom import vocab
from aeroloom.functions.times import as_date, normalize_time
from aeroloom.operators import filters, normalize
from aeroloom.operators.rollups import resample_mean
from aeroloom.sinks import tables

RUN_LOG = ("run_id string, source string, first_day date, last_day date, run_started timestamp, run_finished timestamp, row_count bigint, "
           "latest_ts timestamp, written boolean, aggregate boolean, agg_interval string, status string")


def standard_rows(payload: DataFrame, source: str, start, end) -> DataFrame:
    """Rows of a source's parsed payloads in its wide schema, with one ``ts``, of the days ``start`` .. ``end``."""
    rows = normalize.standardize(payload, source)
    timed = normalize_time(rows.drop("ts"))
    placed = normalize.float_coords(timed, [p for p in vocab.COORDS[source] if p[0] in timed.columns])
    days = placed.filter(F.to_date("ts").between(F.lit(as_date(start)), F.lit(as_date(end)))).withColumn("timestamp", F.col("ts"))
    return normalize.conform(filters.require(days, ["native_sensor_id"]), vocab.WIDE_SCHEMAS[source])


def resampled(rows: DataFrame, source: str, interval: str) -> DataFrame:
    """Means per sensor and interval in the source's wide schema; what a mean makes no sense of is left out for weather."""
    exclude = vocab.WU_RESAMPLE_EXCLUDE if source == "WU" else ()
    means = resample_mean(rows.drop("timestamp"), "native_sensor_id", "ts", interval, exclude)
    return normalize.conform(means.withColumn("timestamp", F.col("ts")), vocab.WIDE_SCHEMAS[source])


def ingest(payloads: dict[str, DataFrame], landing_root: str, staging: str, run_log: str, start, end, force: bool = False,
           interval: str | None = None) -> dict[str, int]:
    """Land and stage the payloads of each source for a range of days and log the run; returns rows landed per source.

    Each source is standardised once and landed, as ``raw`` or, with an ``interval``, as means under its name; staging and
    the counts of the log read what was landed.  Days already landed stay unless ``force``.  The log has one row per source:
    the run's id, times, interval and status, whether anything was written, and the rows and latest time.
    """
    run_id, started, counted = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc), {}
    agg = interval or "raw"
    for source, payload in payloads.items():
        spark = payload.sparkSession
        rows = standard_rows(payload, source, start, end)
        rows = resampled(rows, source, interval) if interval else rows
        tables.write_landing(rows.drop("ts"), landing_root, source, agg, force=force)
        path = f"{landing_root}/source={source}/agg={agg}"
        found = (0, None)
        if tables.exists(spark, path):
            landed = (spark.read.schema(vocab.WIDE_SCHEMAS[source] + ", dt date").parquet(path)
                      .filter(F.col("dt").between(F.lit(as_date(start)), F.lit(as_date(end)))).withColumn("ts", F.col("timestamp").cast("timestamp")))
            long = normalize.source_long(landed, source).select("timestamp", F.col("native_sensor_id").alias("deployment_fk"), "metric_name", "value")
            tables.write_staging(long, staging, source.lower())
            found = tuple(landed.agg(F.count(F.lit(1)), F.max("ts")).first())
        counted[source] = found[0]
        log = [(run_id, source, as_date(start), as_date(end), started, dt.datetime.now(dt.timezone.utc), *found, found[0] > 0, interval is not None, agg, "success")]
        tables.append_run_log(spark.createDataFrame(log, RUN_LOG), run_log)
    return counted
