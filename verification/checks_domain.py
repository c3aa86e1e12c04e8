"""Classification, health, alerts and views (sections 2.10 and 2.12, M1-M5, M13-M14)."""

from pyspark.sql import functions as F

from aeroloom import vocab
from aeroloom.functions import air
from aeroloom.operators import alerts as al, health as h, locations, reports, timeseries
from aeroloom.plans import views
from verification.feeds import NOW
from verification.registry import add

_HEALTH = lambda v: f"""CASE WHEN {v} <= 12 THEN 'Good' WHEN {v} <= 35.5 THEN 'Moderate' WHEN {v} <= 55.5 THEN 'Unhealthy for Sensitive Groups'
    WHEN {v} <= 150.5 THEN 'Unhealthy' WHEN {v} <= 250.5 THEN 'Very Unhealthy' ELSE 'Hazardous' END"""


def _aqi(v):
    return "CASE " + " ".join(
        f"WHEN {v} >= {lo} AND {v} <= {hi} THEN round_even((({a1} - {a0}) / ({hi}::DOUBLE - {lo}::DOUBLE)) * ({v} - {lo}::DOUBLE) + {a0}, 0)::INT"
        for lo, hi, a0, a1 in vocab.AQI_BREAKPOINTS) + " ELSE 500 END"


add("c01_health_category", lambda d: d.history().select("event_id", air.health_category(F.col("pm25")).alias("category")),
    f"SELECT event_id, {_HEALTH('pm25')} AS category FROM history")
add("c02_aqi_parity", lambda d: d.history().select("event_id", air.aqi(F.col("pm25"), parity=True).alias("aqi")),
    f"SELECT event_id, {_aqi('pm25')} AS aqi FROM history")
add("c02_aqi", lambda d: d.history().select("event_id", air.aqi(F.col("pm25")).alias("aqi")),
    f"SELECT event_id, {_aqi('x')} AS aqi FROM (SELECT event_id, floor(round(pm25 * 10, 6)) / 10.0::DOUBLE AS x FROM history)")
add("c03_aqi_bucket", lambda d: d.history().select("event_id", air.aqi_bucket(F.col("pm25")).alias("bucket")),
    """SELECT event_id, CASE WHEN pm25 <= 12 THEN 'Good' WHEN pm25 <= 35 THEN 'Moderate' WHEN pm25 <= 55 THEN 'Unhealthy for Sensitive'
       ELSE 'Unhealthy' END AS bucket FROM history""")
add("c04_extreme_events", lambda d: reports.extreme_events(d.enriched(), "2023-11-01"),
    """SELECT * FROM (SELECT CAST(day_ts AS DATE) AS date, native_sensor_id, metric_name, avg_value, min_value, max_value, CASE
         WHEN metric_name = 'temperature' AND max_value >= 35 THEN 'Extreme Heat' WHEN metric_name = 'temperature' AND min_value <= 0 THEN 'Freezing'
         WHEN metric_name = 'humidity' AND avg_value >= 90 THEN 'Very Humid' WHEN metric_name = 'pm2_5' AND avg_value >= 55 THEN 'Unhealthy Air'
         WHEN metric_name = 'uv_high' AND max_value >= 8 THEN 'Very High UV' END AS event_type FROM enriched
       WHERE status = 'active' OR status IS NULL) WHERE event_type IS NOT NULL""", "avg_value min_value max_value")
_HOURS = """(SELECT count(*) FILTER (pm25 <= 12)::BIGINT AS good_air_hours, count(*) FILTER (pm25 > 12 AND pm25 <= 35.5)::BIGINT AS moderate_air_hours,
    count(*) FILTER (pm25 > 35.5 AND pm25 <= 55.5)::BIGINT AS unhealthy_sensitive_hours,
    count(*) FILTER (pm25 > 55.5 AND pm25 <= 150.5)::BIGINT AS unhealthy_hours, count(*) FILTER (pm25 > 150.5)::BIGINT AS very_unhealthy_hours,
    count(*)::BIGINT AS total_hours FROM history)"""
_ADVICE = """CASE WHEN very_unhealthy_hours > 0 THEN 'HEALTH_EMERGENCY' WHEN unhealthy_hours > total_hours * 0.1 THEN 'HEALTH_WARNING'
    WHEN unhealthy_sensitive_hours > total_hours * 0.2 THEN 'HEALTH_ADVISORY' ELSE 'NORMAL' END"""
add("a32_exposure_hours", lambda d: h.exposure_hours(d.history()), f"SELECT * FROM {_HOURS}")
add("c05_advisory_level", lambda d: h.advisory_level(h.exposure_hours(d.history())), f"SELECT *, {_ADVICE} AS health_advisory_level FROM {_HOURS}")
add("c06_population_impact", lambda d: h.population_impact(h.exposure_hours(d.history())),
    f"""SELECT *, 330000::BIGINT AS total_population, 82500::BIGINT AS sensitive_population,
        CASE WHEN moderate_air_hours > 0 THEN 82500 ELSE 0 END::BIGINT AS at_risk_during_moderate,
        CASE WHEN unhealthy_hours > 0 THEN 330000 ELSE 0 END::BIGINT AS at_risk_during_unhealthy FROM {_HOURS}""")
add("a31_category_distribution", lambda d: h.category_distribution(d.history()),
    f"""SELECT category, n AS count, round(n / sum(n) OVER ()::DOUBLE * 100, 1) AS percentage, row_number() OVER (ORDER BY n DESC, category) = 1 AS predominant
        FROM (SELECT {_HEALTH('pm25')} AS category, count(*)::BIGINT AS n FROM history GROUP BY 1)""", "percentage")


def _quoted(texts):
    return "'" + " / ".join(texts).replace("'", "''") + "'"


_ADVISE = "CASE " + " ".join(
    f"WHEN pm25 > {bound} THEN {_quoted(texts + vocab.GENERAL_RECOMMENDATIONS)}" if bound is not None
    else f"ELSE {_quoted(texts + vocab.GENERAL_RECOMMENDATIONS)}" for bound, _, texts in vocab.HEALTH_RECOMMENDATIONS) + " END"
add("c07_recommendations",
    lambda d: h.with_recommendations(d.history(), "pm25").select("event_id", F.concat_ws(" / ", "recommendations").alias("advice")),
    f"SELECT event_id, {_ADVISE} AS advice FROM history")


def _report(d, **how):
    r = h.health_report(d.history(), ties=["event_id"], **how)
    return r.select("period_start", "period_end", "total_readings", "average_pm25", "maximum_pm25", "predominant_category",
                    "exposure.health_advisory_level", "exposure.unhealthy_hours", F.size("distribution").cast("bigint").alias("categories"),
                    F.concat_ws(" / ", "recommendations").alias("advice"))


_LAST = "(SELECT * FROM history ORDER BY timestamp DESC, event_id DESC LIMIT 168)"
add("c08_health_report_last", lambda d: _report(d, last=168),
    f"""SELECT period_start, period_end, total_readings, average_pm25, maximum_pm25, predominant_category, {_ADVICE} AS health_advisory_level,
        unhealthy_hours, categories, {_ADVISE} AS advice FROM (SELECT min(timestamp) AS period_start, max(timestamp) AS period_end,
        count(*)::BIGINT AS total_readings, round(avg(pm25), 1) AS average_pm25, round(max(pm25), 1) AS maximum_pm25, avg(pm25) AS pm25,
        (SELECT category FROM (SELECT {_HEALTH('pm25')} AS category, count(*) AS n FROM {_LAST} GROUP BY 1) ORDER BY n DESC, category LIMIT 1) AS predominant_category,
        count(DISTINCT {_HEALTH('pm25')})::BIGINT AS categories, count(*) FILTER (pm25 > 35.5 AND pm25 <= 55.5) AS unhealthy_sensitive_hours,
        count(*) FILTER (pm25 > 55.5 AND pm25 <= 150.5)::BIGINT AS unhealthy_hours, count(*) FILTER (pm25 > 150.5) AS very_unhealthy_hours,
        count(*) AS total_hours FROM {_LAST})""", "average_pm25 maximum_pm25")


def _predicted(d):
    """Hourly values per sensor standing in for a forecast: the n-th latest reading is n hours ahead."""
    late = timeseries.last_n(d.history(), "timestamp", 30, "native_sensor_id", ["event_id"])
    numbered = timeseries.sequence_rows(late, ["native_sensor_id"], "timestamp", ["event_id"])
    return numbered.select("native_sensor_id", F.col("seq").cast("int").alias("hours_ahead"), F.round(F.col("pm25") / 4, 2).alias("predicted_pm25"))


_AHEAD = """(SELECT native_sensor_id, row_number() OVER (PARTITION BY native_sensor_id ORDER BY timestamp, event_id) AS hours_ahead,
    round(pm25 / 4, 2) AS predicted_pm25 FROM (SELECT *, row_number() OVER (PARTITION BY native_sensor_id ORDER BY timestamp DESC, event_id DESC) AS rn
    FROM history) WHERE rn <= 30)"""
_WEEK = "(SELECT * FROM history WHERE epoch_us(timestamp) > (SELECT max(epoch_us(timestamp)) FROM history) - 168 * 3600000000::BIGINT)"
add("c08_health_report", _report,
    f"""SELECT period_start, period_end, total_readings, average_pm25, maximum_pm25, predominant_category, {_ADVICE} AS health_advisory_level,
        unhealthy_hours, categories, {_ADVISE} AS advice FROM (SELECT min(timestamp) AS period_start, max(timestamp) AS period_end,
        count(*)::BIGINT AS total_readings, round(avg(pm25), 1) AS average_pm25, round(max(pm25), 1) AS maximum_pm25, avg(pm25) AS pm25,
        (SELECT category FROM (SELECT {_HEALTH('pm25')} AS category, count(*) AS n FROM {_WEEK} GROUP BY 1) ORDER BY n DESC, category LIMIT 1) AS predominant_category,
        count(DISTINCT {_HEALTH('pm25')})::BIGINT AS categories, count(*) FILTER (pm25 > 35.5 AND pm25 <= 55.5) AS unhealthy_sensitive_hours,
        count(*) FILTER (pm25 > 55.5 AND pm25 <= 150.5)::BIGINT AS unhealthy_hours, count(*) FILTER (pm25 > 150.5) AS very_unhealthy_hours,
        count(*) AS total_hours FROM {_WEEK})""", "average_pm25 maximum_pm25")


def _predicted(d):
    """Hourly values per sensor standing in for a forecast: the n-th latest reading is n hours ahead."""
    late = timeseries.last_n(d.history(), "timestamp", 30, "native_sensor_id", ["event_id"])
    numbered = timeseries.sequence_rows(late, ["native_sensor_id"], "timestamp", ["event_id"])
    return numbered.select("native_sensor_id", F.col("seq").cast("int").alias("hours_ahead"), F.round(F.col("pm25") / 4, 2).alias("predicted_pm25"))


_AHEAD = """(SELECT native_sensor_id, row_number() OVER (PARTITION BY native_sensor_id ORDER BY timestamp, event_id) AS hours_ahead,
    round(pm25 / 4, 2) AS predicted_pm25 FROM (SELECT *, row_number() OVER (PARTITION BY native_sensor_id ORDER BY timestamp DESC, event_id DESC) AS rn
    FROM history) WHERE rn <= 30)"""
add("c09_forecast_advisory", lambda d: h.forecast_advisory(_predicted(d), key="native_sensor_id").select("native_sensor_id", "level"),
    f"""SELECT native_sensor_id, CASE WHEN top >= 150 THEN 'emergency' WHEN top >= 55 THEN 'warning' WHEN top >= 35 THEN 'advisory'
        WHEN mean > 15 THEN 'watch' ELSE 'good' END AS level FROM (SELECT native_sensor_id, max(predicted_pm25) AS top, avg(predicted_pm25) AS mean
        FROM {_AHEAD} WHERE hours_ahead <= 24 GROUP BY 1)""")
add("c10_confidence", lambda d: _predicted(d).select("native_sensor_id", "hours_ahead", air.confidence(F.col("hours_ahead")).alias("confidence")),
    f"""SELECT native_sensor_id, hours_ahead::INT AS hours_ahead, CASE WHEN hours_ahead <= 6 THEN 'high' WHEN hours_ahead <= 24 THEN 'medium'
        ELSE 'low' END AS confidence FROM {_AHEAD}""")
add("c11_classify_sources", lambda d: views.classify_sources(d.daily()),
    "SELECT native_sensor_id, 'TSI' AS sensor_source FROM tsi_list UNION ALL SELECT native_sensor_id, 'WU' FROM wu_list")
_E = "latitude longitude avg_value min_value max_value value"
add("c12_enriched", lambda d: d.enriched().drop("geog"), "SELECT * FROM enriched", _E)
add("c12_all_enriched", lambda d: views.all_daily_enriched(d.daily(), d.id_map(), d.current()).drop("geog"), "SELECT * FROM all_enriched", _E)
add("c12_long_enriched",
    lambda d: views.long_enriched(d.long(), d.id_map(), d.current()).drop("geog"),
    """SELECT f.timestamp, f.native_sensor_id, coalesce(m.sensor_id, f.native_sensor_id) AS sensor_id, f.metric_name, f.value, lc.latitude,
       lc.longitude, lc.status, lc.effective_date FROM long f LEFT JOIN id_map m ON f.native_sensor_id = m.native_sensor_id
       AND (m.effective_start_date IS NULL OR CAST(f.timestamp AS DATE) >= m.effective_start_date)
       AND (m.effective_end_date IS NULL OR CAST(f.timestamp AS DATE) <= m.effective_end_date)
       LEFT JOIN current_loc lc ON f.native_sensor_id = lc.native_sensor_id""", "latitude longitude value")
add("c12_metric_subset_view",
    lambda d: views.metric_subset_view(d.daily(), d.id_map(), d.current(), ["humidity", "wind_direction_avg"], "WU")
    .drop("geog", "metric", "value"),
    "SELECT * EXCLUDE (metric, value), 'WU' AS sensor_type FROM enriched WHERE metric_name IN ('humidity', 'wind_direction_avg')",
    "latitude longitude avg_value min_value max_value")
add("c13_location_current", lambda d: d.current().select("native_sensor_id", "geog.longitude", "geog.latitude", "status"),
    "SELECT native_sensor_id, longitude, latitude, status FROM current_loc", "longitude latitude")
add("c14_canonical_location", lambda d: d.canonical().drop("canonical_geog"), "SELECT * FROM canonical", "canonical_latitude canonical_longitude")


def _catalog(d):
    """Catalogue: every supplier, some renamed, plus sensors that are in no other table."""
    base = d.table("supplier").selectExpr(
        "concat('KNCDURHA', s_suppkey * 2) AS native_sensor_id", "CASE WHEN s_suppkey >= 0 THEN 'WU' END AS sensor_type",
        "CASE WHEN s_suppkey % 3 = 0 THEN concat('renamed ', s_suppkey) ELSE s_name END AS friendly_name",
        "CASE WHEN s_suppkey % 4 = 0 THEN concat('roof ', s_suppkey) END AS location", "36.0D AS latitude", "-78.9D AS longitude",
        "CASE WHEN s_suppkey % 5 = 0 THEN date'2024-01-03' END AS start_date")
    return base


def _maintained(d, part):
    seen = locations.identity_candidates(d.history()).select("native_sensor_id")
    first = (d.history().groupBy("native_sensor_id").agg(F.to_date(F.min("timestamp")).alias("first_date"))
             .join(seen, "native_sensor_id").withColumn("sensor_type", F.when(F.col("first_date").isNotNull(), "TSI")))
    return locations.maintain_deployments(d.sensors(), d.deployments(), _catalog(d), first, "2024-01-31", algo="sha2")[part]


_CATALOG = """(SELECT 'KNCDURHA' || (s_suppkey * 2) AS native_sensor_id, 'WU' AS sensor_type, CASE WHEN s_suppkey % 3 = 0 THEN 'renamed ' || s_suppkey
    ELSE s_name END AS friendly_name, CASE WHEN s_suppkey % 4 = 0 THEN 'roof ' || s_suppkey END AS location, 36.0::DOUBLE AS latitude,
    -78.9::DOUBLE AS longitude, CASE WHEN s_suppkey % 5 = 0 THEN date '2024-01-03' END AS start_date FROM supplier)"""
_WANTED = f"""(SELECT native_sensor_id, sensor_type, friendly_name AS new_name, coalesce(location, friendly_name) AS new_location, latitude AS new_lat,
    longitude AS new_lon, coalesce(start_date, date '2024-01-31') AS new_start FROM {_CATALOG} UNION ALL
    SELECT native_sensor_id, 'TSI', native_sensor_id, native_sensor_id, NULL, NULL, CAST(min(timestamp) AS DATE) FROM history GROUP BY 1)"""
_SENSORS = f"""(SELECT coalesce(s.sensor_pk, sha256(w.sensor_type || '|' || w.native_sensor_id)) AS sensor_pk, native_sensor_id, sensor_type,
    coalesce(w.new_name, s.friendly_name) AS friendly_name FROM sensors s FULL JOIN {_WANTED} w USING (native_sensor_id, sensor_type))"""
add("c15_maintained_sensors", lambda d: _maintained(d, 0), f"SELECT * FROM {_SENSORS}")
add("c15_maintained_deployments", lambda d: _maintained(d, 1),
    f"""SELECT coalesce(p.deployment_pk, sha256(k.sensor_pk || '|' || k.new_start)) AS deployment_pk, coalesce(p.sensor_fk, k.sensor_pk) AS sensor_fk,
        coalesce(k.new_location, p.location) AS location, CASE WHEN p.deployment_pk IS NULL THEN k.new_lat ELSE p.latitude END AS latitude,
        CASE WHEN p.deployment_pk IS NULL THEN k.new_lon ELSE p.longitude END AS longitude,
        CASE WHEN p.deployment_pk IS NULL THEN 'active' ELSE p.status END AS status, least(p.start_date, k.new_start) AS start_date, p.end_date
        FROM (SELECT * FROM deployments WHERE end_date IS NULL) p FULL JOIN (SELECT x.sensor_pk, w.* FROM {_WANTED} w JOIN {_SENSORS} x
        USING (native_sensor_id, sensor_type)) k ON p.sensor_fk = k.sensor_pk UNION ALL SELECT * FROM deployments WHERE end_date IS NOT NULL""",
    "latitude longitude")

# --- alerts ---
_ID = lambda prefix: f"'{prefix}_' || strftime(timestamp, '%Y%m%d_%H%M%S') AS id"


def _alert_sql(prefix, kind, metric, cases, source="history"):
    level = "CASE " + " ".join(f"WHEN {c} THEN '{name}'" for c, name, _, _ in cases) + " END"
    bound = "CASE " + " ".join(f"WHEN {c} THEN {b}" for c, _, b, _ in cases) + " END"
    said = "CASE " + " ".join(f"WHEN {c} THEN printf('{text}', {metric})" for c, _, _, text in cases) + " END"
    advice = "CASE " + " ".join(
        (f"WHEN {metric} {op} {b} THEN" if op else "ELSE") + f" {_quoted(t)}" for op, b, t in vocab.ALERT_RECOMMENDATIONS[metric]) + " END"
    return f"""SELECT native_sensor_id, {_ID(prefix)}, '{kind}' AS type, {level} AS level, timestamp, '{metric}' AS metric, {metric} AS value,
        ({bound})::DOUBLE AS threshold, {said} AS message, '' AS missing, {advice} AS advice, 'active' AS status FROM {source} WHERE {level} IS NOT NULL"""


_PM = [("pm25 >= 150.0", "critical", "150.0", "CRITICAL: PM2.5 level extremely high at %.1f μg/m³"),
       ("pm25 >= 55.5", "high", "55.5", "HIGH: PM2.5 level unhealthy at %.1f μg/m³"),
       ("pm25 >= 35.5", "medium", "35.5", "MODERATE: PM2.5 level elevated at %.1f μg/m³")]
_TEMP = [("temperature >= 40.0", "high", "40.0", "EXTREME HEAT: Temperature %.1f°C exceeds safe limits"),
         ("temperature <= -20.0", "high", "-20.0", "EXTREME COLD: Temperature %.1f°C below safe limits")]
_RH = [("humidity >= 95.0", "medium", "95.0", "EXTREME HUMIDITY: Humidity %.1f%% extremely high"),
       ("humidity <= 5.0", "medium", "5.0", "EXTREME DRYNESS: Humidity %.1f%% extremely low")]
_ALERTS = " UNION ALL ".join([_alert_sql("pm25", "air_quality", "pm25", _PM), _alert_sql("temp", "temperature", "temperature", _TEMP),
                              _alert_sql("humidity", "humidity", "humidity", _RH)])


def flat_alerts(df):
    """Alert rows with their lists as text."""
    return df.withColumns({"missing": F.concat_ws(", ", "missing_metrics"), "advice": F.concat_ws(" / ", "recommendations")}).drop(
        "missing_metrics", "recommendations")


add("m01_threshold_alerts", lambda d: flat_alerts(al.threshold_alerts(d.history())), _ALERTS, "value threshold")
_LACK = "concat_ws(', ', CASE WHEN pm25 IS NULL THEN 'pm25' END, CASE WHEN temperature IS NULL THEN 'temperature' END, CASE WHEN humidity IS NULL THEN 'humidity' END)"
add("m02_missing_metric_alerts", lambda d: flat_alerts(al.missing_metric_alerts(d.sparse())),
    f"""SELECT native_sensor_id, {_ID('data_missing')}, 'data_quality' AS type, 'medium' AS level, timestamp, 'data_completeness' AS metric,
        NULL::DOUBLE AS value, NULL::DOUBLE AS threshold, 'DATA MISSING: Critical metrics unavailable: ' || {_LACK} AS message, {_LACK} AS missing,
        {_quoted(vocab.ALERT_RECOMMENDATIONS['data_completeness'][0][2])} AS advice, 'active' AS status FROM sparse WHERE {_LACK} <> ''""",
    "value threshold")
_KEPT = lambda part, order: f"""(WITH RECURSIVE a AS (SELECT {part} AS k, timestamp, id, level, native_sensor_id, value FROM ({_ALERTS})
      QUALIFY row_number() OVER (PARTITION BY k, timestamp ORDER BY id, native_sensor_id, level, value) = 1),
    kept AS (SELECT k, min(timestamp) AS timestamp FROM a GROUP BY 1 UNION ALL
      SELECT k.k, (SELECT min(a.timestamp) FROM a WHERE a.k = k.k AND a.timestamp >= k.timestamp + interval 60 minute) FROM kept k
      WHERE (SELECT min(a.timestamp) FROM a WHERE a.k = k.k AND a.timestamp >= k.timestamp + interval 60 minute) IS NOT NULL)
    SELECT a.* FROM kept JOIN a USING (k, timestamp))"""


def _cooled(d, keys):
    return al.apply_cooldown(al.threshold_alerts(d.history()), 60, keys)


add("m03_apply_cooldown", lambda d: _cooled(d, ["type"]).select("type", "timestamp", "id", "native_sensor_id", "level", "value"),
    f"SELECT k AS type, timestamp, id, native_sensor_id, level, value FROM {_KEPT('type', '')}", "value")
add("m03_apply_cooldown_by_sensor",
    lambda d: _cooled(d, ["native_sensor_id", "type"]).select(F.concat_ws("/", "native_sensor_id", "type").alias("key"), "timestamp", "id", "level", "value"),
    f"""SELECT k AS key, timestamp, id, level, value FROM {_KEPT("native_sensor_id || '/' || type", '')}""", "value")
add("m04_auto_resolve", lambda d: al.auto_resolve(al.threshold_alerts(d.history()), "2024-01-30 12:00:00").groupBy("type", "status")
    .agg(F.count(F.lit(1)).alias("alerts")),
    f"""SELECT type, CASE WHEN timestamp < timestamp '2024-01-30 10:00:00' THEN 'auto_resolved' ELSE 'active' END AS status, count(*)::BIGINT AS alerts
        FROM ({_ALERTS}) GROUP BY 1, 2""")
_RECENT = f"(SELECT * FROM ({_ALERTS}) WHERE timestamp > timestamp '2024-01-30 00:00:00')"
add("m05_alert_summary", lambda d: al.alert_summary(al.threshold_alerts(d.history()), NOW),
    f"""SELECT 'total' AS kind, NULL::VARCHAR AS name, count(*)::BIGINT AS alerts FROM {_RECENT} UNION ALL
        SELECT 'active', NULL, count(*) FILTER (status = 'active')::BIGINT FROM {_RECENT} UNION ALL
        SELECT 'level', level, count(*)::BIGINT FROM {_RECENT} GROUP BY 2 UNION ALL SELECT 'type', type, count(*)::BIGINT FROM {_RECENT} GROUP BY 2""")
add("m05_recent_critical", lambda d: al.recent_critical(al.threshold_alerts(d.history()), NOW).select("id", "level", "timestamp"),
    f"""SELECT id, level, timestamp FROM (SELECT * FROM {_RECENT} ORDER BY timestamp DESC, id DESC LIMIT 10) WHERE level IN ('critical', 'high')""")

_LIMIT = "CASE r.metric_name WHEN 'temperature' THEN 3.0 WHEN 'humidity' THEN 3.0 WHEN 'pm25' THEN 2.5 END"


def _readings(d):
    """Long form of the history, over all sensors of a metric."""
    return d.history().selectExpr("'network' AS native_sensor_id", "event_id", "timestamp",
                                  "stack(2, 'pm25', pm25, 'temperature', temperature) AS (metric_name, value)")


_NET = """(SELECT 'network' AS native_sensor_id, event_id, timestamp, 'pm25' AS metric_name, pm25 AS value FROM history UNION ALL
    SELECT 'network', event_id, timestamp, 'temperature', temperature FROM history)"""
add("m13_zscore_anomalies",
    lambda d: al.zscore_anomalies(_readings(d)).select("event_id", "metric_name", "value", F.round("baseline_mean", 5).alias("baseline_mean"),
                                                       F.round("z_score", 5).alias("z_score")),
    f"""SELECT r.event_id, r.metric_name, r.value, round(b.m, 5) AS baseline_mean, round((r.value - b.m) / b.sd, 5) AS z_score FROM {_NET} r JOIN (
        SELECT x.metric_name, x.day, avg(y.value) AS m, stddev_samp(y.value) AS sd FROM (SELECT DISTINCT metric_name, CAST(timestamp AS DATE) AS day FROM {_NET}) x
        JOIN {_NET} y ON y.metric_name = x.metric_name AND CAST(y.timestamp AS DATE) < x.day AND CAST(y.timestamp AS DATE) >= x.day - 7 GROUP BY 1, 2) b
        ON b.metric_name = r.metric_name AND b.day = CAST(r.timestamp AS DATE) WHERE b.sd > 0 AND abs((r.value - b.m) / b.sd) > {_LIMIT}""", "value")
add("m14_sensor_health",
    lambda d: al.sensor_health(d.history(), "pm25", NOW, ties=["event_id"]),
    """SELECT native_sensor_id, count(*) FILTER (run >= 3)::BIGINT AS consecutive_runs, max(gap) AS longest_gap_hours,
       (epoch_us(timestamp '2024-01-31') - max(epoch_us(timestamp))) / 3.6e9 AS silent_hours, 100.0::DOUBLE * count(*) FILTER (same) / count(*) AS repeated_pct,
       count(*) FILTER (run >= 3) > 0 AS sustained, greatest(coalesce(max(gap), 0), (epoch_us(timestamp '2024-01-31') - max(epoch_us(timestamp))) / 3.6e9) > 6 AS missing_data,
       100.0::DOUBLE * count(*) FILTER (same) / count(*) > 20 AS stuck,
       count(*) FILTER (z > 2.5)::BIGINT AS outliers, count(*) FILTER (z > 2.5) > 10 AS noisy FROM (SELECT native_sensor_id, timestamp,
         abs(pm25 - avg(pm25) OVER (PARTITION BY native_sensor_id)) / nullif(stddev_samp(pm25) OVER (PARTITION BY native_sensor_id), 0) AS z,
         sum(CAST(pm25 >= 35.5 AS INT)) OVER (PARTITION BY native_sensor_id ORDER BY timestamp, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS run,
         (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY native_sensor_id ORDER BY timestamp, event_id))) / 3.6e9 AS gap,
         pm25 = lag(pm25) OVER (PARTITION BY native_sensor_id ORDER BY timestamp, event_id) AS same FROM history) GROUP BY 1""",
    "longest_gap_hours silent_hours repeated_pct")
