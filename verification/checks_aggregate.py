"""Aggregations (section 2.6)."""

from pyspark.sql import functions as F

from aeroloom.operators import locations, quality, reports, rollups
from aeroloom.plans import views
from verification.feeds import PROC_DATE
from verification.registry import add

_STATS = "latitude longitude avg_value min_value max_value"
MONTH = "2023-12-31"
WEEK = "2024-01-24"
_ACTIVE = "(status = 'active' OR status IS NULL)"
_MATRIX = ["temperature", "humidity", "pm2_5", "wind_speed_avg"]

add("a01_hourly_rollup", lambda d: rollups.hourly_rollup(d.long(), PROC_DATE).drop("geog"),
    "SELECT * FROM hourly WHERE hour_ts >= timestamp '2024-01-30' AND hour_ts < timestamp '2024-01-31'", _STATS)
add("a02_daily_rollup", lambda d: rollups.daily_rollup(d.long(), PROC_DATE).drop("geog"), "SELECT * FROM week", _STATS)
add("a01_hourly_from_wide", lambda d: d.hourly().drop("geog"), "SELECT * FROM hourly", _STATS)
add("a02_daily_from_wide", lambda d: d.daily().drop("geog"), "SELECT * FROM daily", _STATS)
add("a03_hourly_row_id", lambda d: rollups.rollup_with_row_id(d.long(), "hour", "sha2"),
    """SELECT hour_ts, CAST(hour_ts AS DATE) AS hour_date, native_sensor_id, metric_name, avg_value, min_value, max_value, samples,
       sha256(strftime(hour_ts, '%Y-%m-%d %H:%M:%S') || '|' || native_sensor_id || '|' || metric_name) AS row_id FROM hourly""",
    "avg_value min_value max_value")
add("a03_daily_row_id", lambda d: rollups.rollup_with_row_id(d.long(), "day", "sha2"),
    """SELECT day_ts, CAST(day_ts AS DATE) AS day_date, native_sensor_id, metric_name, avg_value, min_value, max_value, samples,
       sha256(strftime(day_ts, '%Y-%m-%d %H:%M:%S') || '|' || native_sensor_id || '|' || metric_name) AS row_id FROM daily""",
    "avg_value min_value max_value")


def _bins(source, key, ts, cols, step):
    means = ", ".join(f"avg({c}) AS {c}" for c in cols)
    return f"""SELECT s.{key}, s.bin AS {ts}, {', '.join(f'b.{c}' for c in cols)} FROM
        (SELECT {key}, unnest(generate_series(low, high, interval '{step}')) AS bin FROM (SELECT {key},
           min(time_bucket(interval '{step}', {ts}, timestamp '1970-01-01')) AS low,
           max(time_bucket(interval '{step}', {ts}, timestamp '1970-01-01')) AS high FROM {source} GROUP BY 1)) s
        LEFT JOIN (SELECT {key}, time_bucket(interval '{step}', {ts}, timestamp '1970-01-01') AS bin, {means} FROM {source} GROUP BY 1, 2) b
        ON s.{key} = b.{key} AND s.bin = b.bin"""


add("a04_resample_tsi", lambda d: rollups.resample_mean(d.tsi(), "native_sensor_id", "ts", "h"),
    _bins("tsi", "native_sensor_id", "ts", ["latitude", "longitude", "pm2_5", "pm10", "pm1_0", "temperature", "humidity"], "1 hour"),
    "latitude longitude pm2_5 pm10 pm1_0 temperature humidity")
add("a04_resample_wu", lambda d: rollups.resample_mean(d.wu(), "native_sensor_id", "ts", "6h", ("epoch", "lat", "lon", "qcStatus")),
    _bins("wu", "native_sensor_id", "ts", ["temperature", "humidity", "precip_rate", "wind_speed_avg"], "6 hours"),
    "temperature humidity precip_rate wind_speed_avg")


def _representative(d):
    lat, lon = rollups.representative("latitude", "longitude", "ts")
    return d.tsi().groupBy("native_sensor_id").agg(lat, lon)


add("a05_representative", _representative,
    "SELECT native_sensor_id, arg_min(latitude, ts) AS latitude, arg_min(longitude, ts) AS longitude FROM tsi GROUP BY 1", "latitude longitude")


def _places(d):
    seen = (locations.positions(d.wu(), "WU", "2023-11-02", PROC_DATE)
            .unionByName(locations.positions(d.tsi(), "TSI", "2023-11-02", PROC_DATE)))
    return locations.daily_positions(seen)


add("a06_daily_positions", _places, "SELECT * FROM places", "lat_r lon_r")
add("a07_mode_coord", lambda d: locations.mode_coord(_places(d)), "SELECT * FROM mode_coord", "lat_r lon_r")
add("a08_window_stats", lambda d: locations.window_stats(_places(d)), "SELECT * FROM place_stats")
add("a09_null_rates", lambda d: quality.null_rates(d.tsi(), "ts", ["pm2_5", "temperature", "humidity"]),
    "SELECT CAST(ts AS DATE) AS date, count(*)::BIGINT AS total_records, " + ", ".join(
        f"""count(*) FILTER ({m} IS NULL)::BIGINT AS null_{m},
        round(100.0::DOUBLE * count(*) FILTER ({m} IS NULL) / count(*), 2) AS null_{m}_pct"""
        for m in ("pm2_5", "temperature", "humidity")) + " FROM tsi GROUP BY 1",
    "null_pm2_5_pct null_temperature_pct null_humidity_pct")
add("a10_metric_coverage", lambda d: quality.metric_coverage(d.tsi(), "ts", ["pm2_5", "pm10", "temperature"]),
    " UNION ALL ".join(
        f"""SELECT CAST(ts AS DATE) AS date, '{m}' AS metric, count(*)::BIGINT AS reading_count,
        count(DISTINCT native_sensor_id) FILTER ({m} IS NOT NULL)::BIGINT AS device_count,
        count(*) FILTER ({m} IS NULL)::BIGINT AS null_count, count({m})::BIGINT AS valid_count FROM tsi GROUP BY 1"""
        for m in ("pm2_5", "pm10", "temperature")))
_PICK = ", ".join(f"max(CASE WHEN metric_name = '{m}' THEN avg_value END) AS {m}" for m in _MATRIX)
add("a11_metric_matrix", lambda d: reports.metric_matrix(d.enriched(), ["native_sensor_id"], _MATRIX, last_reading="day_ts"),
    f"SELECT native_sensor_id, {_PICK}, max(day_ts) AS last_reading FROM enriched GROUP BY 1", " ".join(_MATRIX))
add("a11_latest_positions", lambda d: reports.latest_positions(d.enriched(), per_sensor=True).select("native_sensor_id", "day_ts", "metric_name", "avg_value", "latitude", "longitude"),
    f"""SELECT native_sensor_id, day_ts, metric_name, avg_value, latitude, longitude FROM (SELECT *, rank() OVER (PARTITION BY native_sensor_id
        ORDER BY day_ts DESC) AS r FROM enriched WHERE {_ACTIVE} AND latitude IS NOT NULL AND longitude IS NOT NULL) WHERE r = 1""",
    "avg_value latitude longitude")
add("a11_latest_day", lambda d: reports.latest_positions(d.enriched()).select("native_sensor_id", "metric_name", "avg_value", "latitude", "longitude", "day_ts", "status"),
    f"""SELECT native_sensor_id, metric_name, avg_value, latitude, longitude, day_ts, status FROM enriched
        WHERE day_ts = (SELECT max(day_ts) FROM enriched) AND {_ACTIVE}""", "avg_value latitude longitude")
add("a11_positions_by_sensor", lambda d: reports.latest_positions(d.enriched(), per_sensor=True).select("native_sensor_id", "day_ts", "metric_name", "avg_value", "latitude", "longitude"),
    f"""SELECT native_sensor_id, day_ts, metric_name, avg_value, latitude, longitude FROM (SELECT *, rank() OVER (PARTITION BY native_sensor_id
        ORDER BY day_ts DESC) AS r FROM enriched WHERE {_ACTIVE} AND latitude IS NOT NULL AND longitude IS NOT NULL) WHERE r = 1""",
    "avg_value latitude longitude")
add("a11_correlation_rows", lambda d: reports.correlation_rows(d.enriched(), MONTH, ["temperature", "humidity", "pm2_5"], ["temperature", "humidity"]),
    f"""SELECT CAST(day_ts AS DATE) AS date, native_sensor_id, max(CASE WHEN metric_name = 'temperature' THEN avg_value END) AS temperature,
        max(CASE WHEN metric_name = 'humidity' THEN avg_value END) AS humidity, max(CASE WHEN metric_name = 'pm2_5' THEN avg_value END) AS pm2_5
        FROM enriched WHERE day_ts >= '{MONTH}' AND {_ACTIVE} GROUP BY 1, 2
        HAVING max(CASE WHEN metric_name = 'temperature' THEN avg_value END) IS NOT NULL
        AND max(CASE WHEN metric_name = 'humidity' THEN avg_value END) IS NOT NULL""", "temperature humidity pm2_5")
add("a12_spatial_grid", lambda d: reports.spatial_grid(d.enriched(), WEEK),
    f"""SELECT round(latitude, 2) AS lat_cluster, round(longitude, 2) AS lng_cluster, count(DISTINCT native_sensor_id)::BIGINT AS sensors_in_area,
        avg(CASE WHEN metric_name = 'temperature' THEN avg_value END) AS avg_temperature,
        avg(CASE WHEN metric_name = 'pm2_5' THEN avg_value END) AS avg_pm25 FROM enriched WHERE day_ts >= '{WEEK}' AND {_ACTIVE} GROUP BY 1, 2""",
    "lat_cluster lng_cluster avg_temperature avg_pm25")
_AVGS = ", ".join(f"avg(CASE WHEN metric_name = '{m}' THEN avg_value END) AS {m}" for m in _MATRIX)
add("a13_pivot_totals", lambda d: reports.pivot_totals(d.daily(), "native_sensor_id", _MATRIX),
    f"""SELECT native_sensor_id, {_AVGS}, avg(avg_value) AS total FROM daily GROUP BY 1 UNION ALL
        SELECT 'TOTAL', {_AVGS}, avg(avg_value) FROM daily""", " ".join(_MATRIX) + " total")
add("a14_availability", lambda d: reports.availability(d.daily(), "pm2_5", "2023-11-01", PROC_DATE),
    """SELECT native_sensor_id, CAST(day_ts AS DATE) AS date, count(*)::BIGINT AS readings FROM daily
       WHERE metric_name = 'pm2_5' GROUP BY 1, 2""")
add("a14_availability_wide", lambda d: reports.availability(d.daily(), "pm2_5", WEEK, PROC_DATE, wide=True),
    "SELECT native_sensor_id, " + ", ".join(
        f"count(*) FILTER (CAST(day_ts AS DATE) = date '2024-01-{i}')::BIGINT AS \"2024-01-{i}\"" for i in range(24, 31))
    + " FROM week WHERE metric_name = 'pm2_5' GROUP BY 1")
add("a15_sensor_summary", lambda d: reports.sensor_summary(d.enriched(), WEEK),
    f"""SELECT native_sensor_id, status, count(DISTINCT metric_name)::BIGINT AS metrics_count,
        count(DISTINCT CAST(day_ts AS DATE))::BIGINT AS days_active, max(day_ts) AS last_reading, avg(samples) AS avg_samples_per_day
        FROM enriched WHERE day_ts >= '{WEEK}' GROUP BY 1, 2""", "avg_samples_per_day")
add("a16_metric_trend", lambda d: reports.metric_trend(d.enriched(["temperature"]), "temperature", MONTH),
    f"""SELECT CAST(day_ts AS DATE) AS date, native_sensor_id, avg(avg_value) AS avg_value, min(min_value) AS min_value,
        max(max_value) AS max_value FROM enriched WHERE metric_name = 'temperature' AND day_ts >= '{MONTH}' AND {_ACTIVE} GROUP BY 1, 2""",
    "avg_value min_value max_value")
add("a16_low_samples", lambda d: reports.low_samples(d.enriched(), WEEK),
    f"""SELECT native_sensor_id, metric_name, CAST(day_ts AS DATE) AS date, samples, avg_value FROM enriched
        WHERE samples < 10 AND day_ts >= '{WEEK}' AND {_ACTIVE}""", "avg_value")
add("a16_latest_active", lambda d: reports.latest_active(d.enriched(), MONTH),
    f"""SELECT day_ts, native_sensor_id, metric_name, avg_value, min_value, max_value, samples, latitude, longitude FROM enriched
        WHERE day_ts >= '{MONTH}' AND {_ACTIVE}""", _STATS)
add("a17_pm25_daily", lambda d: reports.pm25_daily(d.enriched(["pm2_5"]), "pm2_5", MONTH),
    f"""SELECT CAST(day_ts AS DATE) AS date, avg(avg_value) AS avg_pm25, min(min_value) AS min_pm25, max(max_value) AS max_pm25,
        CASE WHEN avg(avg_value) <= 12 THEN 'Good' WHEN avg(avg_value) <= 35 THEN 'Moderate'
             WHEN avg(avg_value) <= 55 THEN 'Unhealthy for Sensitive' ELSE 'Unhealthy' END AS aqi_category,
        count(DISTINCT native_sensor_id)::BIGINT AS sensors_reporting FROM enriched
        WHERE metric_name = 'pm2_5' AND day_ts >= '{MONTH}' AND {_ACTIVE} GROUP BY 1""", "avg_pm25 min_pm25 max_pm25")
add("a18_coverage_pct", lambda d: reports.coverage_pct(d.enriched(), MONTH),
    f"""SELECT native_sensor_id, count(DISTINCT CAST(day_ts AS DATE))::BIGINT AS days_with_data,
        count(DISTINCT metric_name)::BIGINT AS metrics_reported,
        round(count(DISTINCT CAST(day_ts AS DATE)) / 30.0::DOUBLE * 100, 1) AS coverage_percent
        FROM enriched WHERE day_ts >= '{MONTH}' GROUP BY 1""", "coverage_percent")
add("a19_weekday_pattern", lambda d: reports.weekday_pattern(d.enriched(), MONTH),
    f"""SELECT (dayofweek(day_ts) + 1)::INT AS day_of_week, dayname(any_value(day_ts)) AS day_name, metric_name,
        avg(avg_value) AS avg_value, stddev_samp(avg_value) AS std_dev FROM enriched WHERE day_ts >= '{MONTH}' AND {_ACTIVE} GROUP BY 1, 3""",
    "avg_value std_dev")
add("a19_week_lines", lambda d: reports.week_lines(d.enriched(["temperature"]), "temperature", "2024-01-02"),
    f"""SELECT CAST(strftime(day_ts, '%U') AS INT) AS week, (dayofweek(day_ts) + 1)::INT AS day_of_week, avg(avg_value) AS avg_value
        FROM enriched WHERE metric_name = 'temperature' AND day_ts >= '2024-01-02' AND {_ACTIVE} GROUP BY 1, 2""", "avg_value")
add("a20_metric_stats", lambda d: reports.metric_stats(d.enriched(), MONTH),
    f"""SELECT metric_name, count(DISTINCT native_sensor_id)::BIGINT AS sensors, avg(avg_value) AS mean, stddev_samp(avg_value) AS std_dev,
        min(min_value) AS overall_min, max(max_value) AS overall_max, quantile_cont(avg_value, 0.5) AS median
        FROM enriched WHERE day_ts >= '{MONTH}' AND {_ACTIVE} GROUP BY 1""", "mean std_dev overall_min overall_max median")
_CARD = "avg(CASE WHEN metric_name = '{m}' AND CAST(day_ts AS DATE) = date '{d}' THEN avg_value END)"
add("a21_scorecards", lambda d: reports.scorecards(d.enriched(), "2024-01-31"),
    f"""SELECT count(DISTINCT native_sensor_id)::BIGINT AS active_sensors,
        {_CARD.format(m='temperature', d='2024-01-30')} AS latest_temperature, {_CARD.format(m='temperature', d='2024-01-29')} AS previous_temperature,
        {_CARD.format(m='pm2_5', d='2024-01-30')} AS latest_pm25, {_CARD.format(m='pm2_5', d='2024-01-29')} AS previous_pm25,
        100.0::DOUBLE * count(*) / (count(DISTINCT native_sensor_id) * count(DISTINCT metric_name)) AS coverage_pct
        FROM enriched WHERE day_ts >= '2024-01-24' AND {_ACTIVE}""",
    "latest_temperature previous_temperature latest_pm25 previous_pm25 coverage_pct")
add("a21_sensor_counts", lambda d: reports.sensor_counts(d.enriched(), "2023-11-01"),
    f"""SELECT CAST(day_ts AS DATE) AS date, metric_name, count(DISTINCT native_sensor_id)::BIGINT AS sensors FROM enriched
        WHERE {_ACTIVE} GROUP BY 1, 2""")
add("a21_reading_table", lambda d: reports.reading_table(d.enriched(), PROC_DATE, PROC_DATE),
    f"""SELECT native_sensor_id, metric_name, avg(avg_value) AS avg_value, min(min_value) AS min_value, max(max_value) AS max_value,
        sum(samples)::BIGINT AS samples FROM enriched WHERE CAST(day_ts AS DATE) = date '{PROC_DATE}' AND {_ACTIVE} GROUP BY 1, 2""",
    "avg_value min_value max_value")
add("a21_metric_range", lambda d: reports.metric_range(d.enriched(["temperature"]), "temperature", MONTH),
    f"""SELECT native_sensor_id, min(min_value) AS min_value, avg(avg_value) AS avg_value, max(max_value) AS max_value, count(*)::BIGINT AS readings
        FROM enriched WHERE metric_name = 'temperature' AND day_ts >= '{MONTH}' AND {_ACTIVE} GROUP BY 1""", "avg_value min_value max_value")
add("a21_sample_counts", lambda d: reports.sample_counts(d.enriched(["temperature"]), "temperature", MONTH),
    f"""SELECT CAST(day_ts AS DATE) AS date, native_sensor_id, avg(samples) AS avg_samples FROM enriched
        WHERE metric_name = 'temperature' AND day_ts >= '{MONTH}' AND {_ACTIVE} GROUP BY 1, 2""", "avg_samples")
add("a21_metric_scatter", lambda d: reports.metric_scatter(d.enriched(), MONTH, "temperature", "humidity"),
    f"""SELECT native_sensor_id, avg(CASE WHEN metric_name = 'temperature' THEN avg_value END) AS x,
        avg(CASE WHEN metric_name = 'humidity' THEN avg_value END) AS y, count(*)::BIGINT AS size FROM enriched
        WHERE metric_name IN ('temperature', 'humidity') AND day_ts >= '{MONTH}' AND {_ACTIVE} GROUP BY 1""", "x y")
add("a22_source_summary", lambda d: reports.source_summary(views.all_daily_enriched(d.daily(), d.id_map(), d.current())),
    """SELECT sensor_source, sensor_category, count(DISTINCT native_sensor_id)::BIGINT AS sensor_count,
       count(DISTINCT metric_name)::BIGINT AS metric_count, min(day_ts) AS earliest_data, max(day_ts) AS latest_data,
       sum(samples)::BIGINT AS total_samples FROM all_enriched GROUP BY 1, 2""")
add("a23_first_seen", lambda d: rollups.first_seen(d.history()),
    "SELECT native_sensor_id, CAST(min(timestamp) AS DATE) AS first_date FROM history GROUP BY 1")
add("a24_rows_per_day", lambda d: rollups.rows_per_day(d.tsi(), "ts", "2024-01-05", "2024-01-20"),
    """SELECT CAST(ts AS DATE) AS date, count(*)::BIGINT AS row_count FROM tsi
       WHERE CAST(ts AS DATE) BETWEEN date '2024-01-05' AND date '2024-01-20' GROUP BY 1""")
add("a24_table_summaries", lambda d: rollups.table_summaries({"sensor_readings_long": (d.long(), "timestamp"),
                                                              "sensor_readings_daily": (d.daily(), "day_ts")}),
    """SELECT 'sensor_readings_long' AS table_name, min(CAST(timestamp AS DATE)) AS min_date, max(CAST(timestamp AS DATE)) AS max_date,
       count(DISTINCT CAST(timestamp AS DATE))::BIGINT AS days, count(*)::BIGINT AS total_rows FROM long
       UNION ALL SELECT 'sensor_readings_daily', min(CAST(day_ts AS DATE)), max(CAST(day_ts AS DATE)),
       count(DISTINCT CAST(day_ts AS DATE))::BIGINT, count(*)::BIGINT FROM daily""")
add("a25_freshness_counts", lambda d: rollups.freshness_counts({"WU": d.wu().withColumnRenamed("ts", "timestamp"),
                                                                "TSI": d.tsi().withColumnRenamed("ts", "timestamp")}, WEEK),
    """SELECT 'WU' AS source, max(ts) AS latest_ts, count(*)::BIGINT AS row_count FROM wu WHERE ts >= timestamp '2024-01-24'
       UNION ALL SELECT 'TSI', max(ts), count(*)::BIGINT FROM tsi WHERE ts >= timestamp '2024-01-24'""")
add("a26_collection_stats",
    lambda d: rollups.collection_stats(d.table("events").selectExpr(
        "ts AS collection_date", "event_type AS source", "event_id % 97 AS records_collected", "event_id % 3 AS errors_count",
        "value AS duration_seconds"), "2024-01-24 00:00:00"),
    """SELECT CAST(ts AS DATE) AS collection_day, event_type AS source, sum(event_id % 97)::BIGINT AS total_records,
       sum(event_id % 3)::BIGINT AS total_errors, avg(value) AS avg_duration FROM events WHERE ts >= timestamp '2024-01-24' GROUP BY 1, 2""",
    "avg_duration")


def _copies(d):
    """Star rows keyed by sensor, hour and metric: several copies per key, some without a value."""
    return d.star().selectExpr("date_trunc('HOUR', timestamp) AS timestamp", "deployment_fk", "metric_name",
                               "CASE WHEN event_id % 4 <> 0 THEN value END AS value", "event_id")


COPIES = """(SELECT date_trunc('hour', timestamp)::TIMESTAMP AS timestamp, deployment_fk, metric_name,
    CASE WHEN event_id % 4 <> 0 THEN value END AS value, event_id FROM star)"""
add("a33_dedupe_last", lambda d: rollups.dedupe_last(_copies(d), ["timestamp", "deployment_fk", "metric_name"], "event_id"),
    f"""SELECT timestamp, deployment_fk, metric_name, value, event_id FROM (SELECT *, row_number() OVER (
        PARTITION BY timestamp, deployment_fk, metric_name ORDER BY event_id DESC) AS rn FROM {COPIES} WHERE value IS NOT NULL) WHERE rn = 1""",
    "value")
add("a34_distinct_of", lambda d: rollups.distinct_of(d.long(), ["native_sensor_id", "metric_name"]),
    "SELECT DISTINCT native_sensor_id, metric_name FROM long")


def _profile_line(col, kind, i):
    timed = kind == "timestamp_ntz"
    number = kind in ("double", "bigint")
    stats = (f"min({col})::DOUBLE, max({col})::DOUBLE, avg({col})::DOUBLE" if number else "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE")
    times = f"min({col})::TIMESTAMP, max({col})::TIMESTAMP" if timed else "NULL::TIMESTAMP, NULL::TIMESTAMP"
    names = (" AS column_name", " AS data_type", " AS row_count", " AS non_null") if i == 0 else ("",) * 4
    if i == 0:
        stats = "min({0})::DOUBLE AS min_value, max({0})::DOUBLE AS max_value, avg({0})::DOUBLE AS mean_value".format(col)
        times = "NULL::TIMESTAMP AS time_from, NULL::TIMESTAMP AS time_to"
    return (f"SELECT '{col}'{names[0]}, '{kind}'{names[1]}, count(*)::BIGINT{names[2]}, count({col})::BIGINT{names[3]}, {stats}, {times} FROM sparse")


add("a35_profile", lambda d: rollups.profile(d.sparse()),
    " UNION ALL ".join(_profile_line(c, k, i) for i, (c, k) in enumerate([
        ("event_id", "bigint"), ("timestamp", "timestamp_ntz"), ("native_sensor_id", "string"), ("pm25", "double"),
        ("temperature", "double"), ("humidity", "double")])), "min_value max_value mean_value")


def _modelled(d):
    return d.tsi().withColumn("model", F.when(F.expr("substring(native_sensor_id, 2) % 2 = 0"), "old").otherwise("new"))


_FIELDS = {"PM Metrics": ["pm1_0", "pm2_5", "pm10"], "Environmental": ["temperature", "humidity", "baro_inhg"]}
_MODEL = "(SELECT *, CASE WHEN CAST(substr(native_sensor_id, 2) AS BIGINT) % 2 = 0 THEN 'old' ELSE 'new' END AS model, NULL::DOUBLE AS baro_inhg FROM tsi)"
_COVER = " UNION ALL ".join(
    f"""SELECT model, '{cat}' AS category, '{f}' AS field, count(*)::BIGINT AS total_records, count({f})::BIGINT AS non_null,
    round(count({f}) / count(*)::DOUBLE * 100, 1) AS coverage_pct, count(DISTINCT CASE WHEN {f} IS NOT NULL THEN native_sensor_id END)::BIGINT AS sensors_with_data
    FROM {_MODEL} GROUP BY 1""" for cat, fs in _FIELDS.items() for f in fs)
add("a36_field_coverage", lambda d: quality.field_coverage(_modelled(d), ["model"], _FIELDS), _COVER, "coverage_pct")
add("a36_category_coverage", lambda d: quality.category_coverage(quality.field_coverage(_modelled(d), ["model"], _FIELDS), ["model"]),
    f"SELECT model, category, round(avg(non_null / total_records::DOUBLE * 100), 4) AS avg_coverage_pct FROM ({_COVER}) GROUP BY 1, 2",
    "avg_coverage_pct")
add("a36_best_device", lambda d: quality.best_device(d.tsi()),
    """SELECT native_sensor_id, max(CAST(pm1_0 IS NOT NULL AS INT) + CAST(pm2_5 IS NOT NULL AS INT) + CAST(pm10 IS NOT NULL AS INT))::INT AS fields_filled
       FROM tsi GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
