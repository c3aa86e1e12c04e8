"""Joins (section 2.5)."""

from pyspark.sql import functions as F

from aeroloom.operators import joins as j, rollups
from aeroloom.plans import views
from verification.feeds import PROC_DATE
from verification.registry import add

_MAP_ON = """r.native_sensor_id = m.native_sensor_id
    AND (m.effective_start_date IS NULL OR CAST(r.{ts} AS DATE) >= m.effective_start_date)
    AND (m.effective_end_date IS NULL OR CAST(r.{ts} AS DATE) <= m.effective_end_date)"""


def _active(d):
    return j.active_deployments(d.deployments(), d.sensors())


add("j01_attach_deployment",
    lambda d: j.attach_deployment(d.history(), _active(d), "TSI").select("timestamp", "deployment_fk", "pm25"),
    """SELECT h.timestamp, p.deployment_pk AS deployment_fk, h.pm25 FROM history h JOIN sensors s USING (native_sensor_id)
       JOIN deployments p ON p.sensor_fk = s.sensor_pk WHERE p.end_date IS NULL AND s.sensor_type = 'TSI'""", "pm25")
add("j02_keep_sensors", lambda d: j.keep_sensors(d.daily(), views.tsi_sensor_list(d.daily())).drop("geog"),
    "SELECT w.* FROM daily w JOIN tsi_list USING (native_sensor_id)", "latitude longitude avg_value min_value max_value")
add("j03_left_attach",
    lambda d: j.left_attach(d.daily().select("day_ts", "native_sensor_id", "metric_name"),
                            d.curated().select("native_sensor_id", "status", "notes"), "native_sensor_id"),
    "SELECT w.day_ts, native_sensor_id, w.metric_name, c.status, c.notes FROM daily w LEFT JOIN curated c USING (native_sensor_id)")
add("j04_current_locations", lambda d: d.current().drop("geog"),
    "SELECT native_sensor_id, latitude, longitude, status, effective_date, notes, updated_at FROM current_loc", "latitude longitude")
add("j05_map_sensor_id",
    lambda d: j.map_sensor_id(d.wu().select("ts", "native_sensor_id", "temperature"), d.id_map(), "ts"),
    f"""SELECT r.ts, r.native_sensor_id, r.temperature, coalesce(m.sensor_id, r.native_sensor_id) AS sensor_id
        FROM wu r LEFT JOIN id_map m ON {_MAP_ON.format(ts='ts')}""", "temperature")


def _overlapping(d):
    """Every mapping once more, for two weeks and under another name."""
    again = d.id_map().selectExpr("concat('swap-', sensor_id) AS sensor_id", "native_sensor_id",
                                  "date'2024-01-10' AS effective_start_date", "date'2024-01-20' AS effective_end_date",
                                  "source", "updated_at")
    return d.id_map().unionByName(again)


_TWICE = """(SELECT * FROM id_map UNION ALL SELECT 'swap-' || sensor_id, native_sensor_id, date '2024-01-10', date '2024-01-20',
    source, updated_at FROM id_map)"""
add("j05_map_latest_wins",
    lambda d: (j.map_sensor_id(d.wu().select("ts", "native_sensor_id"), _overlapping(d), "ts", "latest")
               .groupBy("sensor_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))),
    f"""SELECT coalesce(m.sensor_id, r.native_sensor_id) AS sensor_id, r.day, sum(n)::BIGINT AS n FROM
        (SELECT native_sensor_id, CAST(ts AS DATE) AS day, count(*) AS n FROM wu GROUP BY 1, 2) r
        LEFT JOIN (SELECT x.native_sensor_id, x.day, arg_max(m.sensor_id, coalesce(m.effective_start_date, date '0001-01-01')) AS sensor_id
          FROM (SELECT DISTINCT native_sensor_id, CAST(ts AS DATE) AS day FROM wu) x JOIN {_TWICE} m ON x.native_sensor_id = m.native_sensor_id
          AND (m.effective_start_date IS NULL OR x.day >= m.effective_start_date)
          AND (m.effective_end_date IS NULL OR x.day <= m.effective_end_date) GROUP BY 1, 2) m
        ON r.native_sensor_id = m.native_sensor_id AND r.day = m.day GROUP BY 1, 2""")
add("j05_overlapping_mappings", lambda d: j.overlapping_mappings(_overlapping(d)),
    f"""SELECT native_sensor_id, min(start_b) AS first_overlap, count(*)::BIGINT AS overlaps FROM (
        SELECT a.native_sensor_id, greatest(coalesce(a.effective_start_date, date '0001-01-01'),
          coalesce(b.effective_start_date, date '0001-01-01')) AS start_b
        FROM {_TWICE} a JOIN {_TWICE} b ON a.native_sensor_id = b.native_sensor_id AND a.sensor_id < b.sensor_id
        AND coalesce(a.effective_start_date, date '0001-01-01') <= coalesce(b.effective_end_date, date '9999-12-31')
        AND coalesce(b.effective_start_date, date '0001-01-01') <= coalesce(a.effective_end_date, date '9999-12-31')) GROUP BY 1""")
add("j06_missing_from",
    lambda d: j.missing_from(d.canonical().select("native_sensor_id", "canonical_latitude"), d.curated(), "native_sensor_id"),
    """SELECT c.native_sensor_id, c.canonical_latitude FROM canonical c LEFT JOIN curated d USING (native_sensor_id)
       WHERE d.native_sensor_id IS NULL""", "canonical_latitude")
add("j07_align_counts",
    lambda d: j.align_counts(rollups.rows_per_day(d.long(["pm2_5"]), "timestamp").withColumnRenamed("row_count", "long_count"),
                             rollups.rows_per_day(d.hourly().filter("metric_name = 'pm2_5' AND day(hour_ts) % 3 > 0"), "hour_ts")
                             .withColumnRenamed("row_count", "hourly_count"), "date"),
    """SELECT coalesce(a.date, b.date) AS date, coalesce(long_count, 0)::BIGINT AS long_count, coalesce(hourly_count, 0)::BIGINT AS hourly_count
       FROM (SELECT CAST(timestamp AS DATE) AS date, count(*) AS long_count FROM long WHERE metric_name = 'pm2_5' GROUP BY 1) a
       FULL JOIN (SELECT CAST(hour_ts AS DATE) AS date, count(*) AS hourly_count FROM hourly
         WHERE metric_name = 'pm2_5' AND day(hour_ts) % 3 > 0 GROUP BY 1) b ON a.date = b.date""")
add("j08_missing_dates",
    lambda d: j.missing_dates(d.enriched(), d.enriched().filter("status = 'active' OR status IS NULL"), "2023-12-31", PROC_DATE, "pm2_5"),
    """SELECT s.native_sensor_id, CAST(g.d AS DATE) AS date, 'MISSING' AS data_status
       FROM (SELECT DISTINCT native_sensor_id FROM enriched WHERE status = 'active' OR status IS NULL) s
       CROSS JOIN (SELECT unnest(generate_series(date '2023-12-31', date '2024-01-30', interval 1 day)) AS d) g
       LEFT JOIN enriched e ON e.native_sensor_id = s.native_sensor_id AND CAST(e.day_ts AS DATE) = CAST(g.d AS DATE)
         AND e.metric_name = 'pm2_5' WHERE e.day_ts IS NULL""")


def _period(d, start, end, name):
    return (d.daily().filter(f"day_ts >= '{start}' AND day_ts < '{end}'").groupBy("native_sensor_id", "metric_name")
            .agg(F.avg("avg_value").alias(name)))


add("j09_join_periods",
    lambda d: j.join_periods(_period(d, "2024-01-24", "2024-01-31", "current_avg"),
                             _period(d, "2024-01-17", "2024-01-24", "previous_avg"), ["native_sensor_id", "metric_name"]),
    """SELECT * FROM (SELECT native_sensor_id, metric_name, avg(avg_value) AS current_avg FROM daily
         WHERE day_ts >= '2024-01-24' AND day_ts < '2024-01-31' GROUP BY 1, 2) c
       LEFT JOIN (SELECT native_sensor_id, metric_name, avg(avg_value) AS previous_avg FROM daily
         WHERE day_ts >= '2024-01-17' AND day_ts < '2024-01-24' GROUP BY 1, 2) p USING (native_sensor_id, metric_name)""",
    "current_avg previous_avg")
add("j10_latest_readings", lambda d: j.latest_readings(d.star(), d.deployments(), d.sensors(), "2024-01-30 00:00:00"),
    """SELECT s.friendly_name, p.location, r.timestamp, r.metric_name, r.value FROM star r
       JOIN deployments p ON r.deployment_fk = p.deployment_pk JOIN sensors s ON p.sensor_fk = s.sensor_pk
       WHERE r.timestamp >= timestamp '2024-01-30 00:00:00'""", "value")
add("j11_active_deployments", _active,
    """SELECT p.deployment_pk, s.native_sensor_id, s.sensor_type FROM deployments p JOIN sensors s ON p.sensor_fk = s.sensor_pk
       WHERE p.end_date IS NULL""")
add("j12_with_bounds",
    lambda d: (j.with_bounds(d.history().withColumn("sec", F.unix_seconds(F.col("timestamp").cast("timestamp"))), "2024-01-10")
               .filter("sec BETWEEN sec_from AND sec_to").select("event_id", "sec", "sec_from", "ms_to")),
    """SELECT event_id, epoch_us(timestamp) // 1000000 AS sec, 1704844800::BIGINT AS sec_from, 1704931199999::BIGINT AS ms_to FROM history
       WHERE epoch_us(timestamp) // 1000000 BETWEEN 1704844800 AND 1704931199""")
