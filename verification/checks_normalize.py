"""Projection and normalisation (section 2.3)."""

from pyspark.sql import functions as F

from aeroloom.functions import air, times
from aeroloom.operators import normalize as n
from aeroloom.sources import payloads
from aeroloom.vocab import MANIFEST, TSI_WIDE_SCHEMA, WU_METRICS
from verification.feeds import TSI_FED, WU_FED
from verification.registry import add


def _raw_wu(d):
    """Weather rows under the field names of the source, with one field twice."""
    return d.wu().selectExpr("native_sensor_id AS stationID", "ts AS obsTimeUtc", "temperature AS tempAvg", "humidity AS humidityAvg",
                             "humidity + 1 AS humidity", "precip_rate AS precipRate", "wind_speed_avg AS windspeedAvg", "lat", "lon")


add("n01_standardize", lambda d: n.standardize(_raw_wu(d), "WU"),
    """SELECT native_sensor_id, ts AS timestamp, temperature, humidity, precip_rate, wind_speed_avg, lat, lon FROM wu""",
    "temperature humidity precip_rate wind_speed_avg lat lon")
add("n01_standardize_tsi",
    lambda d: n.standardize(d.history().selectExpr("native_sensor_id AS device_id", "concat('x', native_sensor_id) AS cloud_device_id",
                                                   "timestamp AS cloud_timestamp", "humidity AS rh", "pm25 AS pm2_5"), "TSI"),
    "SELECT native_sensor_id, timestamp, humidity, pm25 AS pm2_5 FROM history", "humidity pm2_5")
add("n03_canonical_ts",
    lambda d: times.canonical_ts(d.history().select("event_id", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"))),
    """SELECT event_id, date_trunc('second', timestamp)::TIMESTAMP AS timestamp, date_trunc('second', timestamp)::TIMESTAMP AS ts FROM history""")
add("n04_float_coords",
    lambda d: n.float_coords(d.wu().selectExpr("ts", "native_sensor_id", "CAST(lat AS STRING) AS lat", "lon",
                                               "CASE WHEN temperature > 25 THEN lat + 1 END AS lat_f"), [("lat_f", "lat"), ("lon_f", "lon")])
    .select("ts", "native_sensor_id", "lat_f", "lon_f"),
    "SELECT ts, native_sensor_id, CASE WHEN temperature > 25 THEN lat + 1 ELSE lat END AS lat_f, lon AS lon_f FROM wu", "lat_f lon_f")


def _epoch(d, unit):
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    div = lambda k: F.call_function("div", micros, F.lit(k).cast("bigint"))
    value = {"s": div(1000000), "ms": div(1000), "us": micros, "ns": micros * 1000}
    mixed = (F.when(F.col("event_id") % 4 == 0, value["s"]).when(F.col("event_id") % 4 == 1, value["ms"])
             .when(F.col("event_id") % 4 == 2, value["us"]).otherwise(value["ns"]))
    pair = F.when(F.col("event_id") % 3 == 0, value["s"]).when(F.col("event_id") % 3 == 1, value["us"]).otherwise(value["ns"])
    return d.history().select("event_id", (pair if unit == "pair" else mixed).alias("epoch"))


_MIXED = """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN date_trunc('second', timestamp) WHEN event_id % 4 = 1 THEN date_trunc('millisecond', timestamp)
    ELSE timestamp END::TIMESTAMP AS ts FROM history"""
for rule in ("materialize", "normalize_day", "verify"):
    add(f"n05_normalize_time_{rule}", lambda d, rule=rule: times.normalize_time(_epoch(d, "mixed"), rule=rule).select("event_id", "ts"), _MIXED)
add("n05_normalize_time_staging", lambda d: times.normalize_time(_epoch(d, "pair"), rule="staging").select("event_id", "ts"),
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', timestamp) ELSE timestamp END::TIMESTAMP AS ts FROM history")
add("n05_parse_date",
    lambda d: d.history().select("event_id", times.parse_date(
        F.when(F.col("event_id") % 4 == 0, F.date_format("timestamp", "yyyy-MM-dd")).when(F.col("event_id") % 4 == 1, F.date_format("timestamp", "yyyyMMdd"))
        .when(F.col("event_id") % 4 == 2, F.date_format("timestamp", "yyyy/MM/dd")).otherwise("not a date")).alias("day")),
    "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(timestamp AS DATE) END AS day FROM history")


def _loose(d):
    """Air-quality rows with text numbers, some of them broken, one column too many and most missing."""
    return d.history().selectExpr(
        "native_sensor_id", "timestamp", "CAST(CASE WHEN event_id % 6 = 0 THEN 'n/a' ELSE CAST(pm25 AS STRING) END AS STRING) AS pm2_5",
        "CAST(humidity AS FLOAT) AS humidity", "temperature", "event_id AS surplus")


add("n06_conform",
    lambda d: n.conform(_loose(d), TSI_WIDE_SCHEMA).select("native_sensor_id", "timestamp", "pm2_5", "humidity", "temperature", "model", "co2_ppm"),
    """SELECT native_sensor_id, timestamp, CASE WHEN event_id % 6 <> 0 THEN pm25 END AS pm2_5, humidity, temperature, NULL::VARCHAR AS model,
       NULL::DOUBLE AS co2_ppm FROM history""", "pm2_5 humidity temperature co2_ppm")
add("n06_conform_keep",
    lambda d: n.conform(_loose(d), "timestamp timestamp, native_sensor_id string, pm2_5 double, temperature double", "keep"),
    """SELECT timestamp, native_sensor_id, CASE WHEN event_id % 6 = 0 THEN 'n/a' ELSE CAST(pm25 AS VARCHAR) END AS pm2_5, temperature FROM history""",
    "temperature")


def _observations(d):
    """Observation texts whose units sit in nested objects, some of them explicitly null."""
    return d.wu().selectExpr(
        "native_sensor_id", "ts",
        """concat('{"stationID":"', native_sensor_id, '","tempAvg":', temperature, ',"humidityAvg":', humidity,
           ',"imperial":{"tempAvg":', temperature + 100, ',"windspeedAvg":', wind_speed_avg, '}',
           CASE WHEN precip_rate IS NULL THEN ',"metric":{"tempAvg":null}' WHEN temperature > 25 THEN concat(',"metric":{"tempAvg":', temperature - 5, '}')
           ELSE '' END, '}') AS observation""")


add("n08_flatten_units",
    lambda d: payloads.flatten_units(_observations(d)).select("native_sensor_id", "ts", "stationID", "tempAvg", "humidityAvg", "windspeedAvg"),
    """SELECT native_sensor_id, ts, native_sensor_id AS "stationID", CASE WHEN precip_rate IS NULL THEN NULL WHEN temperature > 25 THEN temperature - 5
       ELSE temperature + 100 END AS "tempAvg", humidity AS "humidityAvg", wind_speed_avg AS "windspeedAvg" FROM wu""",
    '"tempAvg" "humidityAvg" "windspeedAvg"')


def _telemetry(d):
    """Telemetry with two sensors per record; the later non-null value of a name wins."""
    m = lambda name, value: f"named_struct('name', '{name}', 'data', named_struct('value', {value}))"
    return d.sparse().selectExpr(
        "event_id", "native_sensor_id", f"""array(
          named_struct('serial', 'A', 'measurements', array({m('PM 2.5', 'pm25 + 1')}, {m('Temperature', 'temperature')})),
          named_struct('serial', CASE WHEN event_id % 2 = 0 THEN 'B' ELSE '' END,
                       'measurements', array({m('PM 2.5', 'CASE WHEN event_id % 3 = 0 THEN pm25 END')}, {m('Relative Humidity', 'humidity')}))) AS sensors""")


_PICKED = """CASE WHEN event_id % 3 = 0 AND pm25 IS NOT NULL THEN pm25 ELSE pm25 + 1 END"""
add("n09_pivot_measurements",
    lambda d: payloads.pivot_measurements(_telemetry(d)).select("event_id", "serial", "pm2_5", "temperature", "rh", "co2_ppm"),
    f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'B' ELSE 'A' END AS serial, {_PICKED} AS pm2_5, temperature, humidity AS rh,
        NULL::DOUBLE AS co2_ppm FROM sparse""", "pm2_5 temperature rh co2_ppm")
add("n09_pivot_measurements_default",
    lambda d: payloads.pivot_measurements(_telemetry(d), missing_default=0.0).select("event_id", "serial", "pm2_5", "rh", "co2_ppm"),
    f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'B' ELSE 'A' END AS serial, coalesce({_PICKED}, 0) AS pm2_5, coalesce(humidity, 0) AS rh,
        0::DOUBLE AS co2_ppm FROM sparse""", "pm2_5 rh co2_ppm")
add("n10_enforce_types",
    lambda d: n.enforce_types(d.history().selectExpr("event_id", "CAST(pm25 AS STRING) AS pm25", "CASE WHEN event_id % 3 > 0 THEN event_id % 3 = 1 END AS is_indoor"),
                              {"pm25": "double", "is_indoor": "boolean"}, parity=True),
    "SELECT event_id, pm25, event_id % 3 = 1 AS is_indoor FROM history", "pm25")
add("n11_unpivot", lambda d: d.long().drop("geog"), "SELECT * FROM long", "value latitude longitude")
add("n11_unpivot_filtered", lambda d: d.long(["pm2_5", "wind_speed_avg"]).drop("geog"),
    "SELECT * FROM long WHERE metric_name IN ('pm2_5', 'wind_speed_avg')", "value latitude longitude")
_LONG_WU = " UNION ALL ".join(f"SELECT ts, native_sensor_id, '{m}' AS metric_name, {m} AS value FROM wu WHERE {m} IS NOT NULL" for m in WU_FED)
add("n12_unpivot_from_manifest", lambda d: n.unpivot_from_manifest(d.wu(), "WU", MANIFEST), _LONG_WU, "value")
add("n13_melt_numeric",
    lambda d: n.melt_numeric(d.tsi().selectExpr("ts", "native_sensor_id", "CAST(pm2_5 AS STRING) AS pm2_5", "pm10", "'text' AS note",
                                                "CAST(NULL AS DOUBLE) AS co_ppm", "latitude"), ["ts", "native_sensor_id"]),
    """SELECT ts, native_sensor_id, 'pm2_5' AS metric_name, pm2_5 AS value FROM tsi WHERE pm2_5 IS NOT NULL UNION ALL
       SELECT ts, native_sensor_id, 'pm10', pm10 FROM tsi WHERE pm10 IS NOT NULL""", "value")
add("n14_drop_columns", lambda d: n.drop_columns(d.tsi(), ["latitude", "longitude", "absent"]),
    "SELECT * EXCLUDE (latitude, longitude) FROM tsi", " ".join(TSI_FED))
add("n15_geo_point",
    lambda d: d.tsi().selectExpr("ts", "native_sensor_id", "CASE WHEN minute(ts) % 4 <> 0 THEN latitude END AS latitude", "longitude")
    .select("ts", "native_sensor_id", air.geo_point(F.col("latitude"), F.col("longitude")).alias("g"))
    .select("ts", "native_sensor_id", F.col("g").isNotNull().alias("has_point"), "g.longitude", "g.latitude"),
    """SELECT ts, native_sensor_id, latitude IS NOT NULL AS has_point, CASE WHEN latitude IS NOT NULL THEN longitude END AS longitude, latitude
       FROM (SELECT ts, native_sensor_id, CASE WHEN minute(ts) % 4 <> 0 THEN latitude END AS latitude, longitude FROM tsi)""", "longitude latitude")
add("n16_row_id",
    lambda d: d.history().select("event_id", air.row_id(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), "native_sensor_id", "event_id", algo="sha2").alias("row_id")),
    "SELECT event_id, sha256(strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '|' || native_sensor_id || '|' || event_id) AS row_id FROM history")
add("n17_tag_source", lambda d: n.tag_source(d.daily().drop("geog"), "TSI", "Air Quality"),
    "SELECT *, metric_name AS metric, avg_value AS value, 'TSI' AS sensor_source, 'Air Quality' AS sensor_category FROM daily",
    "latitude longitude avg_value min_value max_value value")
add("n18_resolve_logical",
    lambda d: n.resolve_logical(n.resolve_logical(d.sparse().selectExpr(
        "event_id", "'none' AS `PM 2.5`", "CAST(NULL AS DOUBLE) AS mcpm2x5", "CAST(pm25 AS STRING) AS `PM2.5`", "pm25 + 5 AS `pm25x`",
        "temperature AS `T (C)`", "humidity AS tempAvg"), "pm25"), "temperature").select("event_id", "pm25", "temperature"),
    "SELECT event_id, pm25, temperature FROM sparse", "pm25 temperature")
add("n19_time_features", lambda d: times.time_features(d.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate"),
    """SELECT o_orderkey, o_orderdate, hour(o_orderdate)::INT AS hour, (isodow(o_orderdate) - 1)::INT AS day_of_week, month(o_orderdate)::INT AS month,
       CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
            WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season FROM orders""")
add("n20_calculated_fields",
    lambda d: n.calculated_fields(d.daily(), "2024-01-31").select("day_ts", "native_sensor_id", "metric_name", "data_quality_score",
                                                                   "days_since_last_reading", "temperature_f", "aqi_category"),
    """SELECT day_ts, native_sensor_id, metric_name, CASE WHEN samples >= 20 THEN 'High' WHEN samples >= 10 THEN 'Medium' ELSE 'Low' END AS data_quality_score,
       date_diff('day', CAST(day_ts AS DATE), date '2024-01-31')::INT AS days_since_last_reading,
       CASE WHEN metric_name = 'temperature' THEN avg_value * 9 / 5 + 32 END AS temperature_f,
       CASE WHEN metric_name = 'pm2_5' THEN CASE WHEN avg_value <= 12 THEN 'Good' WHEN avg_value <= 35 THEN 'Moderate'
         WHEN avg_value <= 55 THEN 'Unhealthy for Sensitive' ELSE 'Unhealthy' END END AS aqi_category FROM daily""", "temperature_f")
assert set(WU_FED) <= set(WU_METRICS)
