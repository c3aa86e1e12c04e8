"""Sources (section 2.1).  Files are first written by Spark from the given tables to the shared folder."""

from pyspark.sql import functions as F

from aeroloom.operators import normalize
from aeroloom.session import scratch_path
from aeroloom.sinks import tables
from aeroloom.sources import catalogs, history, landing, payloads
from aeroloom.vocab import MANIFEST
from verification.feeds import TSI_FED
from verification.registry import add


def landed(d) -> str:
    """Both feeds landed as a tree of days."""
    root = scratch_path(d.spark, "landing")
    wu = d.wu().withColumnRenamed("ts", "timestamp")
    tsi = d.tsi().withColumnRenamed("ts", "timestamp")
    tables.write_landing(wu, root, "WU")
    tables.write_landing(tsi, root, "TSI")
    return root


_COLS = ["timestamp", "native_sensor_id", *TSI_FED, "dt"]
_SEL = "SELECT ts AS timestamp, native_sensor_id, pm2_5, pm10, pm1_0, temperature, humidity, CAST(ts AS DATE) AS dt FROM tsi"
add("s01_scan_landing", lambda d: landing.scan_landing(d.spark, landed(d), "TSI", "raw", "2024-01-10", "2024-01-19").select(_COLS),
    f"{_SEL} WHERE CAST(ts AS DATE) BETWEEN date '2024-01-10' AND date '2024-01-19'", " ".join(TSI_FED))
add("s02_load_day", lambda d: landing.load_day(d.spark, landed(d), "TSI", "2024-01-15").select(_COLS),
    f"{_SEL} WHERE CAST(ts AS DATE) = date '2024-01-15'", " ".join(TSI_FED))
add("s02_load_missing_day", lambda d: landing.load_day(d.spark, landed(d), "TSI", "2024-03-01").select(_COLS),
    f"{_SEL} WHERE CAST(ts AS DATE) = date '2024-03-01'", " ".join(TSI_FED))
add("s03_filter_by_path_date",
    lambda d: landing.filter_by_path_date(d.spark.read.parquet(landed(d) + "/source=TSI/agg=raw"), "2024-01-15").select(
        "timestamp", "native_sensor_id", "pm2_5"),
    "SELECT ts AS timestamp, native_sensor_id, pm2_5 FROM tsi WHERE CAST(ts AS DATE) = date '2024-01-15'", "pm2_5")


def _wu_files(d) -> str:
    """One response per sensor and day, its observations in both unit systems."""
    path = scratch_path(d.spark, "wu-json")
    obs = F.struct(F.col("native_sensor_id").alias("stationID"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("obsTimeUtc"),
                   F.col("humidity").alias("humidityAvg"), F.lit(1).alias("qcStatus"),
                   F.struct(F.col("temperature").alias("tempAvg"), (F.col("wind_speed_avg")).alias("windspeedAvg")).alias("metric"),
                   F.struct((F.col("temperature") * 2).alias("tempAvg"), F.col("lat").alias("dewptAvg")).alias("imperial"))
    # A response holds one sensor's day of an hour, so no response grows with the table.
    grouped = d.wu().groupBy("native_sensor_id", F.date_trunc("hour", "ts").alias("h"), F.floor("wind_speed_avg").alias("part")).agg(
        F.to_json(F.struct(F.collect_list(obs).alias("observations"))).alias("value"))
    grouped.select("value").write.text(path)
    return path


add("s04_read_wu_json",
    lambda d: normalize.standardize(payloads.read_wu_json(d.spark, _wu_files(d)), "WU").select(
        "native_sensor_id", "timestamp", "temperature", "humidity", "wind_speed_avg", "dew_point_avg", "qc_status"),
    """SELECT native_sensor_id, ts AS timestamp, temperature, humidity, wind_speed_avg, lat AS dew_point_avg, 1::BIGINT AS qc_status FROM wu""",
    "temperature humidity wind_speed_avg dew_point_avg")


def _tsi_files(d) -> str:
    path = scratch_path(d.spark, "tsi-json")
    m = lambda name, col: F.struct(F.lit(name).alias("name"), F.struct(F.col(col).alias("value")).alias("data"))
    record = F.struct(
        F.when(F.col("event_id") % 13 != 0, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("cloud_timestamp"),
        F.lit("acct").alias("cloud_account_id"), F.col("native_sensor_id").alias("device_id"), F.lit("m1").alias("model"),
        F.struct(F.struct(F.lit(36.1).alias("latitude"), F.lit(-78.9).alias("longitude")).alias("location"),
                 (F.col("event_id") % 2 == 0).alias("is_indoor")).alias("metadata"),
        F.array(F.struct(F.lit("s1").alias("serial"), F.array(m("PM 2.5", "pm25"), m("Temperature", "temperature")).alias("measurements")),
                F.struct(F.lit("").alias("serial"), F.array(m("Relative Humidity", "humidity")).alias("measurements"))).alias("sensors"))
    d.sparse().select(F.to_json(record).alias("value")).write.text(path)
    return path


add("s05_read_tsi_json",
    lambda d: normalize.standardize(payloads.read_tsi_json(d.spark, _tsi_files(d)), "TSI").select(
        "native_sensor_id", "timestamp", "serial", "latitude", "is_indoor", "is_public", "pm2_5", "temperature", "humidity", "co2_ppm"),
    """SELECT native_sensor_id, timestamp, 's1' AS serial, 36.1::DOUBLE AS latitude, event_id % 2 = 0 AS is_indoor, NULL::BOOLEAN AS is_public,
       pm25 AS pm2_5, temperature, humidity, NULL::DOUBLE AS co2_ppm FROM sparse WHERE event_id % 13 <> 0""",
    "latitude pm2_5 temperature humidity co2_ppm")


def _flat_files(d) -> str:
    path = scratch_path(d.spark, "tsi-flat")
    record = F.struct(F.col("native_sensor_id").alias("cloud_device_id"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
                      F.col("pm25").alias("mcpm2x5"), "temperature", F.col("humidity").alias("rh"))
    d.history().select(F.to_json(record).alias("value")).write.text(path)
    return path


add("s05_read_tsi_flat_json",
    lambda d: normalize.standardize(payloads.read_tsi_flat_json(d.spark, _flat_files(d)), "TSI").select(
        "native_sensor_id", "timestamp", "pm2_5", "temperature", "humidity"),
    "SELECT native_sensor_id, timestamp, pm25 AS pm2_5, temperature, humidity FROM history", "pm2_5 temperature humidity")


def _history_files(d) -> str:
    """Raw pulls of both sources with different columns, as CSV."""
    root = scratch_path(d.spark, "history")
    (d.history().selectExpr("timestamp AS cloud_timestamp", "native_sensor_id", "pm25 AS `PM 2.5`", "temperature AS `T (C)`")
     .write.option("header", True).csv(f"{root}/raw_pulls/tsi/2024"))
    (d.wu().selectExpr("native_sensor_id", "ts AS obsTimeUtc", "temperature AS tempAvg")
     .write.option("header", True).csv(f"{root}/raw_pulls/wu/2024"))
    return root


def _history(d):
    rows = history.read_history_csv(d.spark, _history_files(d))
    return normalize.resolve_logical(rows, "pm25").select(
        "data_source", "native_sensor_id", F.coalesce(F.col("cloud_timestamp"), F.col("obsTimeUtc")).cast("timestamp").alias("timestamp"), "pm25",
        F.coalesce(F.col("`T (C)`"), F.col("tempAvg")).cast("double").alias("temperature"))


add("s06_read_history_csv", _history,
    """SELECT 'tsi' AS data_source, native_sensor_id, date_trunc('millisecond', timestamp)::TIMESTAMP AS timestamp, pm25, temperature FROM history
       UNION ALL SELECT 'wu', native_sensor_id, ts, NULL, temperature FROM wu""", "pm25 temperature")


def _catalog_file(d) -> str:
    """A sensor list of JSON records, one line per test sensor."""
    path = scratch_path(d.spark, "catalog")
    d.table("supplier").selectExpr("s_name AS id", "CASE WHEN s_suppkey % 3 < 2 THEN s_suppkey % 3 = 0 END AS active").select(
        F.to_json(F.struct("id", "active")).alias("value")).write.text(path)
    return path


def _read_lines(d):
    """The list form, read line by line."""
    path = _catalog_file(d)
    rows = d.spark.read.schema("id string, active boolean").json(path)
    out = scratch_path(d.spark, "catalog-array")
    # One configuration file holds the whole list, as the format wants it; its size is that of the sensor list.
    rows.groupBy().agg(F.to_json(F.collect_list(F.struct("id", "active"))).alias("value")).write.text(out)
    return catalogs.sensor_catalog(d.spark, out)


add("s07_sensor_catalog", lambda d: _read_lines(d).select("native_sensor_id", "friendly_name", "active"),
    "SELECT s_name AS native_sensor_id, s_name AS friendly_name, true AS active FROM supplier WHERE s_suppkey % 3 <> 1")
_LISTED = " UNION ALL ".join(f"SELECT '{s}' AS source, unnest([{', '.join(chr(39) + m + chr(39) for m in v['metrics'])}]) AS metric_name"
                             for s, v in MANIFEST.items())
add("s08_manifest_present",
    lambda d: catalogs.manifest_df(d.spark).select("source", "metric_name").join(
        d.long().groupBy("metric_name").agg(F.count(F.lit(1)).alias("readings")), "metric_name", "left"),
    f"""SELECT source, metric_name, readings FROM ({_LISTED}) LEFT JOIN (SELECT metric_name, count(*)::BIGINT AS readings FROM long GROUP BY 1)
        USING (metric_name)""")


def _staged(d):
    rows = d.star().select("timestamp", "deployment_fk", "metric_name", "value")
    for source, even in (("wu", 0), ("tsi", 1)):
        for day in ("2024-01-10", "2024-01-11"):
            if (source, day) == ("wu", "2024-01-11"):
                continue
            part = rows.filter(F.to_date("timestamp") == F.lit(day).cast("date"))
            part = part.filter(F.when(F.col("metric_name") == "pm25", 0).otherwise(1) == even)
            part.createOrReplaceTempView(landing.staging_name(source, day))
    d.spark.catalog.dropTempView(landing.staging_name("wu", "2024-01-11"))


def _resolve(d, **how):
    _staged(d)
    return landing.resolve_staging(d.spark, **how)


_STAR = "SELECT timestamp, deployment_fk, metric_name, value FROM star"
add("s09_resolve_by_source_and_date", lambda d: _resolve(d, sources=["wu", "tsi"], dates=["2024-01-10", "2024-01-11"]),
    f"""{_STAR} WHERE CAST(timestamp AS DATE) = date '2024-01-10' OR (CAST(timestamp AS DATE) = date '2024-01-11' AND metric_name <> 'pm25')""", "value")
add("s09_resolve_by_prefix", lambda d: _resolve(d, prefix="staging_tsi_", suffix="0110"),
    f"{_STAR} WHERE CAST(timestamp AS DATE) = date '2024-01-10' AND metric_name <> 'pm25'", "value")
add("s09_resolve_by_name", lambda d: _resolve(d, tables="staging_wu_20240110"),
    f"{_STAR} WHERE CAST(timestamp AS DATE) = date '2024-01-10' AND metric_name = 'pm25'", "value")
