"""Structured Streaming (section 2.13): streams over the given files, run to the end, then read back."""

from pyspark.sql import functions as F

from aeroloom.operators import alerts as al
from aeroloom.session import scratch_path
from aeroloom.streaming import streams
from verification.checks_domain import _ALERTS, _LACK, _KEPT
from verification.feeds import TSI_FED
from verification.registry import add


def _events(d):
    """The air-quality table as a stream of files."""
    # A pattern, since the table may be one file or a folder of them.
    return streams.read_stream(d.spark, f"{d.dir}/events.parque[t]", d.table("events").schema)


def _readings(d):
    return _events(d).selectExpr(
        "event_id", "CAST(ts AS TIMESTAMP) AS timestamp", "concat('d', CAST(user_id AS STRING)) AS native_sensor_id",
        "CASE WHEN event_id % 5 <> 0 THEN value END AS pm25", "CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 70 - 25 AS DOUBLE) END AS temperature",
        "CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 101 AS DOUBLE) END AS humidity")


def _written(d, df, **how):
    out, checkpoint = scratch_path(d.spark, "stream"), scratch_path(d.spark, "checkpoint")
    streams.append_parquet(df, out, checkpoint, **how).awaitTermination()
    return d.spark.read.parquet(out)


_SPARSE_ALERTS = _ALERTS.replace("FROM history", "FROM sparse")
add("r01_stream_alerts",
    lambda d: _written(d, streams.stream_alerts(_readings(d))).select("native_sensor_id", "id", "type", "level", "timestamp", "value", "message"),
    f"""SELECT native_sensor_id, id, type, level, timestamp, value, message FROM ({_SPARSE_ALERTS}) UNION ALL
        SELECT native_sensor_id, 'data_missing_' || strftime(timestamp, '%Y%m%d_%H%M%S'), 'data_quality', 'medium', timestamp, NULL::DOUBLE,
        'DATA MISSING: Critical metrics unavailable: ' || {_LACK} FROM sparse WHERE {_LACK} <> ''""", "value")


def _dense(d):
    """Stream of the complete history's threshold alerts."""
    rows = _events(d).selectExpr("CAST(ts AS TIMESTAMP) AS timestamp", "concat('d', CAST(user_id AS STRING)) AS native_sensor_id",
                                 "value AS pm25", "CAST(event_id % 70 - 25 AS DOUBLE) AS temperature", "CAST(event_id % 101 AS DOUBLE) AS humidity")
    return al.threshold_alerts(rows)


def _cooled(d):
    out, state, checkpoint = (scratch_path(d.spark, n) for n in ("kept", "state", "checkpoint"))
    streams.stream_cooldown(_dense(d), out, state, checkpoint, keys=["type"]).awaitTermination()
    return d.spark.read.parquet(out).select("type", "timestamp", "id", "native_sensor_id", "level", "value")


add("r02_stream_cooldown", _cooled, f"SELECT k AS type, timestamp, id, native_sensor_id, level, value FROM {_KEPT('type', '')}", "value")


#: Rows of one file of `_in_four`, about.
FILE_ROWS = 250_000


def _in_four(d, name="events"):
    """The events in four loads, one after the other, each from the whole month: streamed load by load, they come out of order.

    A load has as many files as the others, one if any load is small, so that several tasks write and read it.
    """
    path, table = scratch_path(d.spark, "four"), d.table(name)
    rows = {r[0]: r[1] for r in table.groupBy((F.col("event_id") % 4).alias("k")).count().collect()}
    files = max(1, min(rows.get(k, 0) for k in range(4)) // FILE_ROWS)
    for k in range(4):
        load = table.filter(f"event_id % 4 = {k}")
        (load.coalesce(1) if files == 1 else load.repartition(files)).write.mode("append").parquet(path)
    return streams.read_stream(d.spark, path, table.schema, max_files=files)


def _cooled_unordered(d):
    """Within the declared lateness, alerts out of order give what a batch run gives."""
    out, state, checkpoint = (scratch_path(d.spark, n) for n in ("kept", "state", "checkpoint"))
    rows = _in_four(d).selectExpr("CAST(ts AS TIMESTAMP) AS timestamp", "concat('d', CAST(user_id AS STRING)) AS native_sensor_id",
                                  "value AS pm25", "CAST(event_id % 70 - 25 AS DOUBLE) AS temperature", "CAST(event_id % 101 AS DOUBLE) AS humidity")
    found = al.threshold_alerts(rows)
    streams.stream_cooldown(found, out, state, checkpoint, keys=["type"], lateness="40 days").awaitTermination()
    streams.release_alerts(d.spark, found.schema, out, state, keys=["type"], lateness="40 days")
    return d.spark.read.schema(found.schema).parquet(f"{out}/*").select("type", "timestamp", "id", "native_sensor_id", "level", "value")


add("r02_stream_cooldown_unordered", _cooled_unordered, f"SELECT k AS type, timestamp, id, native_sensor_id, level, value FROM {_KEPT('type', '')}", "value")


def _long_stream(d):
    wide = _events(d).selectExpr("CAST(ts AS TIMESTAMP) AS timestamp", "concat('d', CAST(user_id AS STRING)) AS native_sensor_id", "event_type AS metric_name", "value",
                                 "36.0D + (user_id % 7)*0.01D AS latitude", "-78.9D AS longitude")
    return wide.filter("value IS NOT NULL")


# Hours whose end the final watermark (latest time less two hours) has passed.
add("r03_stream_hourly", lambda d: _written(d, streams.stream_hourly(_long_stream(d))).withColumns({"geog_lat": F.col("geog.latitude"), "geog_lon": F.col("geog.longitude")}).drop("geog"),
    """SELECT * FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour_ts, 'd' || CAST(user_id AS VARCHAR) AS native_sensor_id, event_type AS metric_name,
       min(36.0::DOUBLE + (user_id % 7)*0.01::DOUBLE) AS latitude, min(-78.9::DOUBLE) AS longitude,
       avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value, count(*)::BIGINT AS samples,
       min(36.0::DOUBLE + (user_id % 7)*0.01::DOUBLE) AS geog_lat, min(-78.9::DOUBLE) AS geog_lon FROM events GROUP BY 1, 2, 3)
       WHERE hour_ts + interval 1 hour <= (SELECT date_trunc('millisecond', max(ts)) - interval 2 hour FROM events)""", "avg_value min_value max_value latitude longitude geog_lat geog_lon")


def _hours_and_late(d):
    """Rows that came out of order by more than two hours are counted apart: with the hours put out and those still open, none is lost."""
    out, late, state, checkpoint = (scratch_path(d.spark, n) for n in ("hours", "late", "state", "checkpoint"))
    rows = _in_four(d).selectExpr("CAST(ts AS TIMESTAMP) AS timestamp", "concat('d', CAST(user_id AS STRING)) AS native_sensor_id", "event_type AS metric_name", "value",
                                  "36.0D + (user_id % 7)*0.01D AS latitude", "-78.9D AS longitude")
    streams.stream_hourly_complete(rows, out, late, state, checkpoint).awaitTermination()
    keys = ["hour_ts", "native_sensor_id", "metric_name"]
    still = streams.open_hours(d.spark, state)
    hours = d.spark.read.schema(still.schema).parquet(f"{out}/*").unionByName(still)
    counted = streams.late_counts(d.spark.read.schema(rows.schema).parquet(f"{late}/*"))
    return (hours.select(F.lit("hour").alias("kind"), *keys, F.col("samples").alias("n"), "avg_value", "min_value", "max_value", "latitude", "longitude")
            .unionByName(counted.select(F.lit("late").alias("kind"), *keys, F.col("late_rows").alias("n")), allowMissingColumns=True))


_SEEN = "(SELECT " + ", ".join(f"max(ts) FILTER (event_id % 4 <= {k}) - interval 2 hour AS w{k}" for k in range(3)) + " FROM events)"
_TIMED = f"""(SELECT date_trunc('hour', ts)::TIMESTAMP AS hour_ts, 'd' || CAST(user_id AS VARCHAR) AS native_sensor_id, event_type AS metric_name, value, user_id,
    CASE event_id % 4 WHEN 1 THEN date_trunc('hour', ts) + interval 1 hour <= w0 WHEN 2 THEN date_trunc('hour', ts) + interval 1 hour <= w1
      WHEN 3 THEN date_trunc('hour', ts) + interval 1 hour <= w2 ELSE false END AS late FROM events, {_SEEN})"""
add("r03_stream_hourly_complete", _hours_and_late,
    f"""SELECT 'hour' AS kind, hour_ts, native_sensor_id, metric_name, count(*)::BIGINT AS n, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value,
        min(36.0::DOUBLE + (user_id % 7)*0.01::DOUBLE) AS latitude, -78.9::DOUBLE AS longitude FROM {_TIMED} WHERE NOT late GROUP BY 2, 3, 4
        UNION ALL SELECT 'late', hour_ts, native_sensor_id, metric_name, count(*)::BIGINT, NULL, NULL, NULL, NULL, NULL FROM {_TIMED} WHERE late GROUP BY 2, 3, 4""",
    "avg_value min_value max_value latitude longitude")


def _landed(d):
    root, checkpoint = scratch_path(d.spark, "stream-landing"), scratch_path(d.spark, "checkpoint")
    pick = lambda kind, name: f"CASE WHEN event_type='{kind}' THEN value END AS {name}"
    rows = _events(d).selectExpr("CAST(ts AS TIMESTAMP) AS timestamp", "concat('d', CAST(user_id AS STRING)) AS native_sensor_id",
                                 pick("click", "pm2_5"), pick("error", "pm10"), pick("purchase", "pm1_0"), pick("signup", "temperature"), pick("view", "humidity"))
    streams.stream_landing(rows, root, checkpoint, "TSI").awaitTermination()
    return d.spark.read.parquet(root).select("timestamp", "native_sensor_id", *TSI_FED, "source", "agg", F.col("dt").cast("date").alias("dt"))


add("r04_stream_landing", _landed,
    f"SELECT ts AS timestamp, native_sensor_id, {', '.join(TSI_FED)}, 'TSI' AS source, 'raw' AS agg, CAST(ts AS DATE) AS dt FROM tsi", " ".join(TSI_FED))
