"""Data quality (section 2.11)."""

from pyspark.sql import functions as F

from aeroloom.operators import quality as q
from aeroloom.vocab import MANIFEST, ROW_THRESHOLDS
from verification.feeds import NOW, PROC_DATE
from verification.registry import add

_ALL = sorted({m for v in MANIFEST.values() for m in v["metrics"]})
_SQL_ALL = "[" + ", ".join(f"'{m}'" for m in _ALL) + "]"


def _loose(d):
    return d.history().selectExpr("native_sensor_id", "timestamp", "CASE WHEN event_id % 6 = 0 THEN 'n/a' ELSE CAST(pm25 AS STRING) END AS pm2_5",
                                  "CAST(humidity AS FLOAT) AS humidity", "temperature")


add("q01_conformance",
    lambda d: q.conformance(_loose(d), {"timestamp": "timestamp", "native_sensor_id": "string", "pm2_5": "double", "humidity": "double", "model": "string"}),
    """SELECT * FROM (VALUES ('timestamp', 'timestamp', 'timestamp_ntz', true, 0), ('native_sensor_id', 'string', 'string', true, 0),
       ('pm2_5', 'double', 'string', false, 1), ('humidity', 'double', 'float', true, 0), ('model', 'string', NULL, false, 2))
       v(column_name, expected_type, actual_type, type_ok, bad) CROSS JOIN (SELECT count(*)::BIGINT AS total_rows, count(*) FILTER (event_id % 6 = 0) AS broken FROM history)
       """ .replace("SELECT * FROM (VALUES", """SELECT column_name, expected_type, actual_type, type_ok,
       CASE bad WHEN 1 THEN broken WHEN 2 THEN total_rows ELSE 0 END::BIGINT AS bad_rows, total_rows FROM (VALUES"""))
add("q02_null_coverage", lambda d: q.check_null_coverage(d.sparse(), ["timestamp", "pm25", "humidity", "pressure_max"], 0.9),
    " UNION ALL ".join(f"""SELECT '{c}' AS column_name, true AS present, count({c})::BIGINT AS non_null, count({c}) / count(*)::DOUBLE AS coverage,
        count({c}) / count(*)::DOUBLE >= 0.9 AS ok FROM sparse""" for c in ("timestamp", "pm25", "humidity"))
    + " UNION ALL SELECT 'pressure_max', false, 0, 0, false", "coverage")


def _thin(d):
    """Air-quality feed with two days cut and one thinned."""
    return d.tsi().filter("to_date(ts) NOT IN (date'2024-01-07', date'2024-01-20') AND NOT (to_date(ts) = date'2024-01-12' AND hour(ts) > 2)")


_THIN = """(SELECT * FROM tsi WHERE CAST(ts AS DATE) NOT IN (date '2024-01-07', date '2024-01-20')
    AND NOT (CAST(ts AS DATE) = date '2024-01-12' AND hour(ts) > 2))"""
_DAYS = "(SELECT CAST(unnest(generate_series(date '2024-01-01', date '2024-02-02', interval 1 day)) AS DATE) AS date)"
add("q04_check_days", lambda d: q.check_days(_thin(d), "ts", "2024-01-01", "2024-02-02", 100),
    f"""SELECT * FROM (SELECT g.date, coalesce(n, 0)::BIGINT AS row_count, CASE WHEN n IS NULL THEN 'missing' WHEN n < 100 THEN 'low' END AS issue
        FROM {_DAYS} g LEFT JOIN (SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM {_THIN} GROUP BY 1) c ON g.date = c.date) WHERE issue IS NOT NULL""")
add("q05_null_rate", lambda d: q.check_null_rate(d.sparse().withColumnRenamed("timestamp", "ts"), "ts", ["pm25", "temperature", "humidity"], 12.0),
    "SELECT * FROM (" + " UNION ALL ".join(f"""SELECT CAST(timestamp AS DATE) AS date, count(*)::BIGINT AS total_records, '{m}' AS metric,
        count(*) FILTER ({m} IS NULL)::BIGINT AS null_count, round(100.0::DOUBLE * count(*) FILTER ({m} IS NULL) / count(*), 2) AS null_pct
        FROM sparse GROUP BY 1""" for m in ("pm25", "temperature", "humidity")) + ") WHERE null_pct > 12", "null_pct")
add("q06_metric_coverage",
    lambda d: q.check_metric_coverage(_thin(d), "ts", "2024-01-01", "2024-02-02", ["pm2_5", "pm10", "humidity"], 0.2),
    "SELECT * FROM (" + " UNION ALL ".join(f"""SELECT CAST(ts AS DATE) AS date, '{m}' AS metric, count({m}) / count(*)::DOUBLE AS coverage,
        'low coverage' AS issue FROM {_THIN} GROUP BY 1""" for m in ("pm2_5", "pm10", "humidity"))
    + f""") WHERE coverage < 0.2 UNION ALL SELECT g.date, NULL, 0, 'missing day' FROM {_DAYS} g
        WHERE g.date NOT IN (SELECT CAST(ts AS DATE) FROM {_THIN})""", "coverage")
add("q07_rollup_ratio",
    lambda d: q.check_rollup_ratio(d.long(), d.hourly().filter("day(hour_ts) % 5 > 0 AND NOT (day(hour_ts) % 7 = 0 AND hour(hour_ts) > 6)"), 1.4),
    """SELECT *, CASE WHEN long_count > 0 AND hourly_count = 0 THEN 'hourly missing' ELSE 'ratio out of range' END AS issue FROM (
       SELECT date, long_count, hourly_count, hourly_count::DOUBLE / (long_count / 1.4::DOUBLE) AS ratio FROM (
         SELECT l.date, l.n AS long_count, coalesce(h.n, 0)::BIGINT AS hourly_count
         FROM (SELECT CAST(timestamp AS DATE) AS date, count(*)::BIGINT AS n FROM long GROUP BY 1) l
         LEFT JOIN (SELECT CAST(hour_ts AS DATE) AS date, count(*) AS n FROM hourly WHERE day(hour_ts) % 5 > 0
           AND NOT (day(hour_ts) % 7 = 0 AND hour(hour_ts) > 6) GROUP BY 1) h USING (date))) WHERE ratio < 0.5 OR ratio > 1.5""", "ratio")
add("q08_manifest_coverage",
    lambda d: q.manifest_coverage(d.long(), MANIFEST, PROC_DATE).withColumn("missing_metrics", F.concat_ws(",", "missing_metrics")),
    f"""SELECT count(*)::BIGINT AS expected_metric_count, count(*) FILTER (seen)::BIGINT AS present_metric_count,
        count(*) FILTER (seen) / count(*)::DOUBLE AS coverage_fraction, string_agg(m, ',' ORDER BY m) FILTER (NOT seen) AS missing_metrics,
        count(*) FILTER (seen) / count(*)::DOUBLE >= 0.9 AS ok FROM (SELECT m, m IN (SELECT metric_name FROM long
        WHERE CAST(timestamp AS DATE) = date '2024-01-30') AS seen FROM (SELECT unnest({_SQL_ALL}) AS m))""", "coverage_fraction")
_TSI_EXPECTED = "[" + ", ".join(f"'{m}'" for m in MANIFEST["TSI"]["metrics"]) + "]"
_TSI_COUNTS = " UNION ALL ".join(f"SELECT '{c}' AS metric_name, count({e})::BIGINT AS non_null FROM tsi" for c, e in (
    ("ts", "ts"), ("pm2_5", "pm2_5"), ("pm10", "pm10"), ("pm1_0", "pm1_0"), ("temperature", "temperature"), ("humidity", "humidity"), ("battery", "pm10")))
add("q09_compare_metrics", lambda d: q.compare_metrics(d.tsi().withColumn("battery", F.col("pm10")), MANIFEST, "TSI"),
    f"""SELECT coalesce(e.m, c.metric_name) AS metric_name, coalesce(non_null, 0)::BIGINT AS non_null,
        CASE WHEN e.m IS NOT NULL AND non_null > 0 THEN 'present' WHEN e.m IS NOT NULL THEN 'missing' ELSE 'extra' END AS status
        FROM (SELECT unnest({_TSI_EXPECTED}) AS m) e FULL JOIN ({_TSI_COUNTS}) c ON e.m = c.metric_name""")
add("q10_row_thresholds",
    lambda d: q.check_row_thresholds({"sensor_readings_wu_raw": (d.wu(), None), "sensor_readings_long": (d.long(), "timestamp")}, PROC_DATE,
                                     q.row_thresholds(ROW_THRESHOLDS, {"sensor_readings_long": 1000}, {"sensor_readings_long": 10_000_000})),
    """SELECT 'sensor_readings_wu_raw' AS table_name, count(*)::BIGINT AS row_count, 100::BIGINT AS min_required, count(*) >= 100 AS ok FROM wu UNION ALL
       SELECT 'sensor_readings_tsi_raw', NULL, 100, false UNION ALL
       SELECT 'sensor_readings_long', count(*)::BIGINT, 10000000, count(*) >= 10000000 FROM long WHERE CAST(timestamp AS DATE) = date '2024-01-30'""")
add("q11_freshness_days", lambda d: q.freshness_days(d.tsi(), "ts", "2024-02-02"),
    """SELECT max(ts) AS latest_ts, date_diff('day', CAST(max(ts) AS DATE), date '2024-02-02')::INT AS lag_days,
       CASE WHEN date_diff('day', CAST(max(ts) AS DATE), date '2024-02-02') > 1 THEN 1 ELSE 0 END::INT AS exit_code FROM tsi""")
add("q12_freshness_hours", lambda d: q.freshness_hours(d.tsi(), "ts", "2024-02-01 04:00:00"),
    """SELECT latest_ts, age_hours, CASE WHEN age_hours > 36 THEN 'error' WHEN age_hours > 26 THEN 'warn' ELSE 'pass' END AS status FROM (
       SELECT max(ts) AS latest_ts, (epoch_us(timestamp '2024-02-01 04:00:00') - epoch_us(max(ts))) / 3.6e9 AS age_hours FROM tsi)""", "age_hours")
add("q13_staging_presence",
    lambda d: q.staging_presence(d.wu().select(F.lit("wu").alias("source"), F.to_date("ts").alias("dt")).unionByName(
        _thin(d).select(F.lit("tsi").alias("source"), F.to_date("ts").alias("dt"))).distinct(), ["tsi", "wu", "aux"], "2024-01-20"),
    """SELECT * FROM (VALUES ('tsi', date '2024-01-20'), ('wu', date '2024-01-20'), ('aux', date '2024-01-20')) v(source, dt) WHERE (source, dt) NOT IN (
       SELECT 'wu', CAST(ts AS DATE) FROM wu UNION ALL SELECT 'tsi', CAST(ts AS DATE) FROM tsi WHERE CAST(ts AS DATE) <> date '2024-01-20')""")
add("q14_reconcile", lambda d: q.reconcile(_thin(d), d.tsi(), "2024-01-01", "2024-02-02"),
    f"""SELECT *, mat_rows - ext_rows AS delta, CASE WHEN mat_rows = ext_rows THEN 'OK' ELSE 'WARN' END AS status FROM (
        SELECT g.date, coalesce(e.n, 0)::BIGINT AS ext_rows, coalesce(m.n, 0)::BIGINT AS mat_rows FROM {_DAYS} g
        LEFT JOIN (SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM tsi GROUP BY 1) e ON g.date = e.date
        LEFT JOIN (SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM {_THIN} GROUP BY 1) m ON g.date = m.date)""")
add("q14_reconcile_skip", lambda d: q.reconcile(d.tsi(), None, "2024-01-05", "2024-01-09"),
    """SELECT CAST(ts AS DATE) AS date, NULL::BIGINT AS ext_rows, count(*)::BIGINT AS mat_rows, NULL::BIGINT AS delta, 'SKIP' AS status FROM tsi
       WHERE CAST(ts AS DATE) BETWEEN date '2024-01-05' AND date '2024-01-09' GROUP BY 1""")
add("q15_column_tests",
    lambda d: q.column_tests(d.sparse(), ["timestamp", "pm25"], ["event_id", "native_sensor_id"], {"native_sensor_id": ["d1", "d2", "d3"]}),
    """SELECT 'not_null' AS test, 'timestamp' AS column_name, count(*) FILTER (timestamp IS NULL)::BIGINT AS failures FROM sparse UNION ALL
       SELECT 'not_null', 'pm25', count(*) FILTER (pm25 IS NULL)::BIGINT FROM sparse UNION ALL
       SELECT 'accepted_values', 'native_sensor_id', count(*) FILTER (native_sensor_id NOT IN ('d1', 'd2', 'd3'))::BIGINT FROM sparse UNION ALL
       SELECT 'unique', 'event_id', count(*)::BIGINT FROM (SELECT event_id FROM sparse GROUP BY 1 HAVING count(*) > 1) UNION ALL
       SELECT 'unique', 'native_sensor_id', count(*)::BIGINT FROM (SELECT native_sensor_id FROM sparse GROUP BY 1 HAVING count(*) > 1)""")


def _odd(d):
    return d.history().selectExpr("CAST(unix_seconds(CAST(timestamp AS TIMESTAMP)) AS BIGINT) AS epoch", "unix_millis(CAST(timestamp AS TIMESTAMP)) AS event_time",
                                  "CASE WHEN event_id % 9 <> 0 THEN timestamp END AS ts", "CASE WHEN event_id % 8 = 0 THEN 'north' ELSE '36.1' END AS latitude",
                                  "-78.9D AS longitude")


_ISO = "strftime(date_trunc('second', {}(timestamp)), '%Y-%m-%dT%H:%M:%SZ')"
add("q16_time_geo_diagnostics", lambda d: q.time_geo_diagnostics(_odd(d)),
    f"""SELECT 'epoch' AS kind, 'epoch' AS column_name, count(*)::BIGINT AS row_count, min(epoch_us(timestamp) // 1000000)::BIGINT AS min_value,
        max(epoch_us(timestamp) // 1000000)::BIGINT AS max_value, 'seconds' AS scale, {_ISO.format('min')} AS iso_min, {_ISO.format('max')} AS iso_max FROM history
        UNION ALL SELECT 'epoch', 'event_time', count(*)::BIGINT, min(epoch_us(timestamp) // 1000)::BIGINT, max(epoch_us(timestamp) // 1000)::BIGINT,
        'milliseconds', {_ISO.format('min')}, {_ISO.format('max')} FROM history
        UNION ALL SELECT 'missing_ts', 'ts', count(*) FILTER (event_id % 9 = 0)::BIGINT, NULL, NULL, NULL, NULL, NULL FROM history
        UNION ALL SELECT 'bad_coordinate', 'latitude', count(*) FILTER (event_id % 8 = 0)::BIGINT, NULL, NULL, NULL, NULL, NULL FROM history
        UNION ALL SELECT 'bad_coordinate', 'longitude', 0, NULL, NULL, NULL, NULL, NULL
        UNION ALL SELECT 'redundant_time', NULL, 0, NULL, NULL, NULL, NULL, NULL""")
add("q18_check_unique", lambda d: q.check_unique(d.wu(), ["ts", "native_sensor_id"]),
    "SELECT ts, native_sensor_id, count(*)::BIGINT AS occurrences FROM wu GROUP BY 1, 2 HAVING count(*) > 1")
add("q18_active_deployments", lambda d: q.check_unique(
    d.deployments().unionByName(d.deployments().filter("sensor_fk LIKE 'w%'")).filter("end_date IS NULL"), ["sensor_fk"]),
    "SELECT sensor_fk, 2::BIGINT AS occurrences FROM deployments WHERE end_date IS NULL AND sensor_fk LIKE 'w%'")
assert NOW


_METRICS = ("pm2_5", "pm10", "humidity")


def _quality_report(d):
    hourly = d.hourly().filter("day(hour_ts) % 5 > 0 AND NOT (day(hour_ts) % 7 = 0 AND hour(hour_ts) > 6)")
    out = q.quality_report(_thin(d), d.long(), hourly, "2024-01-01", "2024-02-02", _METRICS, max_null_pct=12.0, threshold=0.2, samples_per_hour=1.4)
    return out.groupBy("check", "status").agg(F.count(F.lit(1)).alias("lines"), F.min(F.get_json_object("details", "$.date")).alias("first_day"))


_FOUND = {
    "days": f"""SELECT g.date FROM {_DAYS} g LEFT JOIN (SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM {_THIN} GROUP BY 1) c ON g.date = c.date
        WHERE n IS NULL OR n < 100""",
    "null_rate": " UNION ALL ".join(f"SELECT CAST(ts AS DATE) AS date FROM {_THIN} GROUP BY 1 HAVING 100.0::DOUBLE * count(*) FILTER ({m} IS NULL) / count(*) > 12"
                                    for m in _METRICS),
    "metric_coverage": " UNION ALL ".join(f"SELECT CAST(ts AS DATE) AS date FROM {_THIN} GROUP BY 1 HAVING count({m}) / count(*)::DOUBLE < 0.2" for m in _METRICS)
        + f" UNION ALL SELECT g.date FROM {_DAYS} g WHERE g.date NOT IN (SELECT CAST(ts AS DATE) FROM {_THIN})",
    "rollup_ratio": """SELECT date FROM (SELECT l.date, l.n AS a, coalesce(h.n, 0) AS b FROM (SELECT CAST(timestamp AS DATE) AS date, count(*) AS n FROM long GROUP BY 1) l
        LEFT JOIN (SELECT CAST(hour_ts AS DATE) AS date, count(*) AS n FROM hourly WHERE day(hour_ts) % 5 > 0
          AND NOT (day(hour_ts) % 7 = 0 AND hour(hour_ts) > 6) GROUP BY 1) h USING (date)) WHERE b / (a / 1.4::DOUBLE) NOT BETWEEN 0.5 AND 1.5"""}
add("q04_q07_quality_report", _quality_report, "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS check, CASE WHEN count(*) > 0 THEN 'finding' ELSE 'ok' END AS status, greatest(count(*), 1)::BIGINT AS lines,
        CAST(CAST(min(date) AS DATE) AS VARCHAR) AS first_day FROM ({sql})""" for name, sql in _FOUND.items()) + ")")
