"""Structured Streaming: alerts, cooldown, hourly rollup and landing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aeroloom import vocab
from aeroloom.functions import air
from aeroloom.operators.alerts import apply_cooldown, reading_alerts
from aeroloom.operators.rollups import earliest_first, representative
from aeroloom.sinks import tables


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Stream over files that arrive below ``path``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_alerts(readings: DataFrame, config=vocab.ALERT_CONFIG, ts: str = "timestamp", keep=("native_sensor_id",)) -> DataFrame:
    """Alerts of a stream of wide readings; stateless, the same expressions as in batch."""
    return reading_alerts(readings, config, ts=ts, keep=keep)


def stream_hourly(readings: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Hourly rollup of a stream of long readings, with one location if the readings have coordinates.

    An hour is emitted once the watermark passes its end.  Rows later than ``lateness`` are not in it: land the same
    stream too (`stream_landing`), and the batch rollup of the day counts them, or take `stream_hourly_complete`, which
    writes them beside the hours.
    """
    hour = F.window("timestamp", "1 hour")
    placed = {"latitude", "longitude"} <= set(readings.columns)
    where = list(representative("latitude", "longitude", "timestamp")) if placed else []
    grouped = (readings.withWatermark("timestamp", lateness).groupBy(hour, "native_sensor_id", "metric_name")
               .agg(*where, F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
                    F.max("value").alias("max_value"), F.count(F.lit(1)).alias("samples")))
    at = ["latitude", "longitude", air.geo_point(F.col("latitude"), F.col("longitude")).alias("geog")] if placed else []
    return grouped.select(F.col("window.start").alias("hour_ts"), "native_sensor_id", "metric_name", *at,
                          "avg_value", "min_value", "max_value", "samples")


def append_parquet(df: DataFrame, path: str, checkpoint: str, partition_by=(), available_now: bool = True,
                   interval: str = "1 minute") -> StreamingQuery:
    """Exactly-once append of a stream to a folder of its own."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def stream_landing(readings: DataFrame, root: str, checkpoint: str, source: str, agg: str = "raw",
                   ts: str = "timestamp", available_now: bool = True) -> StreamingQuery:
    """Land a stream under source/agg/day.

    The file sink commits each micro-batch once, so a day that arrives in many batches keeps all its rows;
    overwriting partitions per batch would lose the earlier ones.
    """
    rows = (readings.withColumn(ts, F.col(ts).cast("timestamp")).filter(F.col(ts).isNotNull())
            .withColumns({"source": F.lit(source), "agg": F.lit(agg), "dt": F.to_date(ts)}))
    return append_parquet(rows, root, checkpoint, ("source", "agg", "dt"), available_now)


def _last_batch(spark: SparkSession, state: str, before: int) -> int | None:
    """The latest batch before this one whose state is complete."""
    return next((b for b in range(before - 1, -1, -1) if tables.exists(spark, f"{state}/batch={b}/clock/_SUCCESS")), None)


def _clock(spark: SparkSession, state: str, batch: int | None) -> int | None:
    """Latest event time seen up to a batch, in microseconds."""
    return None if batch is None else spark.read.parquet(f"{state}/batch={batch}/clock").first()["seen"]


def _set_clock(spark: SparkSession, now: int | None, state: str, batch: int) -> None:
    """Write the latest event time: the batch's state is complete then."""
    spark.createDataFrame([(now,)], "seen bigint").coalesce(1).write.mode("overwrite").parquet(f"{state}/batch={batch}/clock")


def _later(rows: DataFrame, at: Column, seen: int | None) -> int | None:
    """Latest event time of what was seen before and these rows."""
    return max((t for t in (rows.agg(F.max(at)).first()[0], seen) if t is not None), default=None)


def _micros(interval: str) -> int:
    n, unit = interval.split()
    return int(float(n) * {"second": 1e6, "minute": 6e7, "hour": 3.6e9, "day": 8.64e10}[unit.rstrip("s")])


def hourly_batch(out: str, late: str, state: str, lateness: str = "2 hours"):
    """``foreachBatch`` function for the hourly rollup that loses no row: what comes too late goes to ``late``.

    An hour is put out once the latest time seen is ``lateness`` past its end, as partial sums of the open hours in ``state``
    and the new rows.  Rows of an hour that is out already are written to ``late`` as they came.  All folders are per
    batch id, so a batch that runs again writes the same.
    """
    keys = ["hour_ts", "native_sensor_id", "metric_name"]
    over = F.unix_micros("hour_ts") + 3_600_000_000
    merge = [F.min_by("latitude", "first").alias("latitude"), F.min_by("longitude", "first").alias("longitude"), F.min("first").alias("first"),
             F.sum("total").alias("total"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.sum("samples").alias("samples")]

    def handle(readings: DataFrame, batch_id: int) -> None:
        spark = readings.sparkSession
        last = _last_batch(spark, state, batch_id)
        seen = _clock(spark, state, last)
        rows = readings.filter(F.col("timestamp").isNotNull()).withColumn("hour_ts", F.date_trunc("hour", "timestamp"))
        closed = over <= (F.lit(seen) - _micros(lateness)) if seen is not None else F.lit(False)
        rows.filter(closed).select(readings.columns).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        fresh = rows.filter(~closed)
        placed = {"latitude", "longitude"} <= set(readings.columns)
        point = [F.col("latitude"), F.col("longitude"), earliest_first("timestamp", "latitude", "longitude").alias("first")] if placed else [
            F.lit(None).cast(k).alias(n) for n, k in (("latitude", "double"), ("longitude", "double"), ("first", "decimal(38,0)"))]
        parts = fresh.select(*keys, *point, F.col("value").alias("total"), F.col("value").alias("min_value"), F.col("value").alias("max_value"), F.lit(1).cast("bigint").alias("samples"))
        if last is not None:
            parts = parts.unionByName(spark.read.parquet(f"{state}/batch={last}/hours").filter(~closed))
        parts.groupBy(*keys).agg(*merge).write.mode("overwrite").parquet(f"{state}/batch={batch_id}/hours")
        now = _later(rows, F.unix_micros(F.col("timestamp").cast("timestamp")), seen)
        hours = spark.read.parquet(f"{state}/batch={batch_id}/hours")
        done = over <= (F.lit(now) - _micros(lateness)) if now is not None else F.lit(False)
        _hour_rows(hours.filter(done)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        _set_clock(spark, now, state, batch_id)

    return handle


def _hour_rows(hours: DataFrame) -> DataFrame:
    return hours.select("hour_ts", "native_sensor_id", "metric_name", "latitude", "longitude", air.geo_point(F.col("latitude"), F.col("longitude")).alias("geog"),
                        (F.col("total") / F.col("samples")).alias("avg_value"), "min_value", "max_value", "samples")


def open_hours(spark: SparkSession, state: str, lateness: str = "2 hours") -> DataFrame:
    """Hours of `hourly_batch` that are not out yet, as they stand."""
    last = max(_batches(spark, state))
    seen = _clock(spark, state, last)
    return _hour_rows(spark.read.parquet(f"{state}/batch={last}/hours").filter(F.unix_micros("hour_ts") + 3_600_000_000 > F.lit(seen) - _micros(lateness)))


def late_counts(late: DataFrame) -> DataFrame:
    """Late rows per hour, sensor and metric."""
    return (late.groupBy(F.date_trunc("hour", "timestamp").alias("hour_ts"), "native_sensor_id", "metric_name").agg(F.count(F.lit(1)).alias("late_rows")))


def _batches(spark: SparkSession, state: str) -> list[int]:
    """Batches whose state is complete, from the folder's listing."""
    return [b for b in tables.numbered_folders(spark, state, "batch=") if tables.exists(spark, f"{state}/batch={b}/clock/_SUCCESS")]


def stream_hourly_complete(readings: DataFrame, out: str, late: str, state: str, checkpoint: str, lateness: str = "2 hours",
                           available_now: bool = True) -> StreamingQuery:
    """Hourly rollup of a stream with its late rows beside it: hours below ``out``, late rows below ``late``."""
    writer = readings.writeStream.foreachBatch(hourly_batch(out, late, state, lateness)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def cooldown_batch(out: str, state: str, minutes: int = vocab.ALERT_CONFIG["alert_rules"]["cooldown_minutes"], keys=("type",), ts: str = "timestamp", ties=("id",), late: str | None = None,
                   lateness: str = "0 seconds"):
    """``foreachBatch`` function that keeps alerts past their cooldown and carries the last kept times.

    Alerts wait in the state until the latest time seen is ``lateness`` past theirs and are then taken in order of time, so
    those that come out of order by no more than that give the result of a batch run; `release_alerts` takes the rest at
    the stream's end.  State and output are written per batch id, each from the state of the batch before: a batch that is run
    again after a failure overwrites its own folders.  The batch itself uses the time-split batch fold, so a
    hot key does not gather in one task.  An alert older than its key's last kept one came too late: whether it would have
    been kept can't be told without undoing what was sent, so it goes to the folder ``late`` (by default ``out`` with
    ``-late``), batch by batch, and nothing is lost.
    """
    late = late or f"{out.rstrip('/')}-late"
    keys = list(keys)
    at = F.unix_micros(F.col(ts).cast("timestamp"))

    def handle(alerts: DataFrame, batch_id: int, final: bool = False) -> None:
        spark = alerts.sparkSession
        last = _last_batch(spark, state, batch_id)
        seen = _clock(spark, state, last)
        now = _later(alerts, at, seen)
        if last is not None:
            alerts = alerts.unionByName(spark.read.schema(alerts.schema).parquet(f"{state}/batch={last}/waiting"))
        wait = F.lit(False) if final or now is None else F.coalesce(at > F.lit(now - _micros(lateness)), F.lit(False))
        alerts.filter(wait).write.mode("overwrite").parquet(f"{state}/batch={batch_id}/waiting")
        columns, alerts = alerts.columns, alerts.filter(~wait)
        earlier = None
        if last is not None:
            earlier = spark.read.parquet(f"{state}/batch={last}/kept")
            before = earlier.withColumnsRenamed({k: f"{k}__k" for k in keys})
            same = F.lit(True)
            for k in keys:
                same = same & alerts[k].eqNullSafe(before[f"{k}__k"])
            known = alerts.join(before, same, "left")
            old = F.coalesce(at < F.col("last_kept"), F.lit(False))
            known.filter(old).select(columns).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
            alerts = known.filter(~old).select(columns)
        kept = apply_cooldown(alerts, minutes, keys, ts, ties, earlier)
        kept.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        # Later steps read what was written, so the fold runs once.
        written = spark.read.parquet(f"{out}/batch={batch_id}")
        newest = written.groupBy(*keys).agg(F.max(at).alias("last_kept"))
        if earlier is not None:
            newest = earlier.unionByName(newest).groupBy(*keys).agg(F.max("last_kept").alias("last_kept"))
        newest.write.mode("overwrite").parquet(f"{state}/batch={batch_id}/kept")
        _set_clock(spark, now, state, batch_id)

    return handle


def release_alerts(spark: SparkSession, schema, out: str, state: str, **how) -> None:
    """Take the alerts that still wait when a stream has ended for good; arguments as for `cooldown_batch`."""
    done = _batches(spark, state)
    if done:
        cooldown_batch(out, state, **how)(spark.createDataFrame([], schema), max(done) + 1, final=True)


def stream_cooldown(alerts: DataFrame, out: str, state: str, checkpoint: str, minutes: int = vocab.ALERT_CONFIG["alert_rules"]["cooldown_minutes"], keys=("type",),
                    ts: str = "timestamp", ties=("id",), available_now: bool = True, late: str | None = None, lateness: str = "0 seconds") -> StreamingQuery:
    """Alerts of a stream that survive the cooldown, written below ``out``; those beyond ``lateness`` below ``late``."""
    writer = (alerts.writeStream.foreachBatch(cooldown_batch(out, state, minutes, keys, ts, ties, late, lateness))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
