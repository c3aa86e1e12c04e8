"""Windows and ordered analyses (section 2.7, with A27-A32 of the seasonal analysis)."""

from pyspark.sql import functions as F

from aeroloom.operators import locations, timeseries as t
from verification.feeds import PROC_DATE
from verification.registry import add

_ACTIVE = "(status = 'active' OR status IS NULL)"


def _snapshots(d):
    """Canonical locations as of two days."""
    older = locations.canonical_location(d.wu(), d.tsi(), "2024-01-15")
    return d.canonical().unionByName(older).drop("canonical_geog")


add("w01_latest_per_key", lambda d: locations.canonical_latest(_snapshots(d)), "SELECT * FROM canonical",
    "canonical_latitude canonical_longitude")
add("w02_top_mode", lambda d: locations.top_mode(
    d.daily().groupBy("native_sensor_id", "metric_name").agg(F.sum("samples").alias("total")), "native_sensor_id",
    [F.desc("total"), F.asc("metric_name")]),
    """SELECT native_sensor_id, metric_name, total FROM (SELECT *, row_number() OVER (PARTITION BY native_sensor_id
       ORDER BY total DESC, metric_name) AS rn FROM (SELECT native_sensor_id, metric_name, sum(samples)::BIGINT AS total
       FROM daily GROUP BY 1, 2)) WHERE rn = 1""")
add("w03_rank_by_metric", lambda d: t.rank_by_metric(d.enriched().filter("status = 'active' OR status IS NULL"), "2024-01-24", digits=8),
    f"""SELECT native_sensor_id, metric_name, round(avg(avg_value), 8) AS avg_value,
        rank() OVER (PARTITION BY metric_name ORDER BY round(avg(avg_value), 8) DESC)::BIGINT AS sensor_rank
        FROM enriched WHERE day_ts >= '2024-01-24' AND {_ACTIVE} GROUP BY 1, 2""", "avg_value")
_BY = "OVER (PARTITION BY native_sensor_id ORDER BY timestamp, event_id"
_LAGS = ", ".join(f"lag(pm25, {n}) {_BY}) AS pm25_lag_{n}h" for n in (1, 6, 12, 24))
add("w04_lag_features", lambda d: t.lag_features(d.history(), "native_sensor_id", "timestamp", "pm25", ties=["event_id"]),
    f"SELECT *, {_LAGS} FROM history",
    "pm25 temperature humidity pm25_lag_1h pm25_lag_6h pm25_lag_12h pm25_lag_24h")
_MAS = lambda first, last: ", ".join(
    f"avg(pm25) {_BY} ROWS BETWEEN {n - 1 + first} PRECEDING AND {last}) AS pm25_ma_{n}h" for n in (3, 6, 24))
add("w05_moving_averages", lambda d: t.moving_averages(d.history(), "native_sensor_id", "timestamp", "pm25", ties=["event_id"]),
    f"SELECT *, {_MAS(1, '1 PRECEDING')} FROM history", "pm25 temperature humidity pm25_ma_3h pm25_ma_6h pm25_ma_24h")
add("w05_moving_averages_current",
    lambda d: t.moving_averages(d.history(), "native_sensor_id", "timestamp", "pm25", include_current=True, ties=["event_id"]),
    f"SELECT *, {_MAS(0, 'CURRENT ROW')} FROM history", "pm25 temperature humidity pm25_ma_3h pm25_ma_6h pm25_ma_24h")
# The same operators with slices and blocks of a few rows, so that every carry-over path is taken.
add("w04_lag_features_sliced",
    lambda d: t.lag_features(d.history(), "native_sensor_id", "timestamp", "pm25", ties=["event_id"], block_rows=25),
    f"SELECT *, {_LAGS} FROM history",
    "pm25 temperature humidity pm25_lag_1h pm25_lag_6h pm25_lag_12h pm25_lag_24h")

_STEP = """(SELECT native_sensor_id, min(ts) AS time_min, max(ts) AS time_max,
    CASE WHEN median(gap) <= 1200 THEN 900 ELSE 3600 END::INT AS step_seconds FROM
    (SELECT native_sensor_id, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY native_sensor_id ORDER BY ts))) / 1e6 AS gap FROM wu)
    GROUP BY 1 HAVING count(gap) > 0)"""
_SLOTS = f"""(SELECT native_sensor_id, step_seconds, unnest(generate_series(CAST(epoch_us(time_min) // (step_seconds::BIGINT * 1000000) AS BIGINT),
    CAST(ceil(epoch_us(time_max) / (step_seconds * 1000000.0::DOUBLE)) AS BIGINT))) AS slot FROM {_STEP})"""
_MISSING = f"""(SELECT s.native_sensor_id, s.slot, s.step_seconds FROM {_SLOTS} s LEFT JOIN
    (SELECT DISTINCT w.native_sensor_id, CAST(epoch_us(w.ts) // (p.step_seconds::BIGINT * 1000000) AS BIGINT) AS slot FROM wu w JOIN {_STEP} p
     USING (native_sensor_id)) x ON s.native_sensor_id = x.native_sensor_id AND s.slot = x.slot WHERE x.slot IS NULL)"""
add("w06_cadence", lambda d: t.cadence(d.wu(), "native_sensor_id", "ts"), f"SELECT * FROM {_STEP}")
add("w06_cadence_summary", lambda d: t.cadence_gaps(d.wu(), "native_sensor_id", "ts")[0],
    f"""SELECT a.native_sensor_id, CASE WHEN a.step_seconds = 900 THEN '15min' ELSE '1h' END AS inferred_freq, a.n AS expected_rows,
        coalesce(m.n, 0)::BIGINT AS missing_count FROM (SELECT native_sensor_id, step_seconds, count(*)::BIGINT AS n FROM {_SLOTS} GROUP BY 1, 2) a
        LEFT JOIN (SELECT native_sensor_id, count(*) AS n FROM {_MISSING} GROUP BY 1) m ON a.native_sensor_id = m.native_sensor_id""")
add("w06_missing_slots", lambda d: t.cadence_gaps(d.wu(), "native_sensor_id", "ts")[1],
    f"""SELECT native_sensor_id, make_timestamp(slot * step_seconds::BIGINT * 1000000) AS missing_slot FROM {_MISSING}""")
add("w06_missing_slots_first", lambda d: t.cadence_gaps(d.wu(), "native_sensor_id", "ts", first=25)[1],
    f"""SELECT native_sensor_id, make_timestamp(slot * step_seconds::BIGINT * 1000000) AS missing_slot FROM (SELECT *, row_number() OVER (
        PARTITION BY native_sensor_id ORDER BY slot) AS rn FROM {_MISSING}) WHERE rn <= 25""")
add("w07_chrono_split", lambda d: t.chrono_split(d.history(), "timestamp", ties=["event_id"]).select("event_id", "split"),
    """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY timestamp, event_id) <= floor(0.8::DOUBLE * count(*) OVER ()) THEN 'train'
       ELSE 'test' END AS split FROM history""")
add("w07_chrono_split_by_sensor",
    lambda d: t.chrono_split(d.history(), "timestamp", key="native_sensor_id", ties=["event_id"]).select("event_id", "split"),
    """SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY native_sensor_id ORDER BY timestamp, event_id)
       <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY native_sensor_id)) THEN 'train' ELSE 'test' END AS split FROM history""")


def _series(d):
    """Daily means per metric over both feeds: one series of thirty days per metric."""
    return d.long().groupBy("metric_name", F.to_date("timestamp").alias("day")).agg(F.avg("value").alias("value"))


_S = """(SELECT metric_name, day, value, row_number() OVER (PARTITION BY metric_name ORDER BY day) - 1 AS i,
    count(*) OVER (PARTITION BY metric_name) AS n FROM (SELECT metric_name, CAST(timestamp AS DATE) AS day, avg(value) AS value
    FROM long GROUP BY 1, 2))"""
_P = f"(SELECT *, CAST(least(30, n // 4) AS INT) AS p FROM {_S} WHERE n >= 30)"
# Thirty days give a period of seven: an odd window of three days on either side.
_T = f"""(SELECT *, CASE WHEN i >= 3 AND i < n - 3 THEN avg(value) OVER (PARTITION BY metric_name ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)
    END AS inner_trend FROM {_P} WHERE p = 7)"""
_FIT = f"""(SELECT metric_name, regr_slope(y1, i) AS hs, regr_intercept(y1, i) AS hi, regr_slope(y2, i) AS s2, regr_intercept(y2, i) AS i2
    FROM (SELECT *, CASE WHEN i >= 3 AND i < 9 THEN inner_trend END AS y1, CASE WHEN i >= n - 10 AND i < n - 4 THEN inner_trend END AS y2
    FROM {_T}) GROUP BY 1)"""
_D = f"""(SELECT t.metric_name, day, value, p, i, CASE WHEN i < 3 THEN hs * i + hi WHEN i > n - 4 THEN s2 * i + i2 ELSE inner_trend END AS trend
    FROM {_T} t JOIN {_FIT} f USING (metric_name))"""
_PH = f"(SELECT metric_name, i % 7 AS phase, avg(value - trend) AS m FROM {_D} GROUP BY 1, 2)"
_DECOMPOSED = f"""SELECT d.metric_name, day, value, p AS period, trend, s.m - g.m AS seasonal, value - trend - (s.m - g.m) AS resid FROM {_D} d
    JOIN {_PH} s ON s.metric_name = d.metric_name AND s.phase = d.i % 7
    JOIN (SELECT metric_name, avg(m) AS m FROM {_PH} GROUP BY 1) g ON g.metric_name = d.metric_name"""
add("w08_decompose", lambda d: t.decompose(_series(d), "metric_name"), _DECOMPOSED, "value trend seasonal resid")


def _long_series(d):
    """Sixty days of mean quantities per return flag."""
    return d.table("lineitem").selectExpr("l_returnflag AS metric_name", "date_add(date'2024-01-01', CAST(datediff(l_shipdate, date'1995-01-01') % 60 AS INT)) AS day",
                                          "l_quantity AS q").groupBy("metric_name", "day").agg(F.avg("q").alias("value"))


# An even period of 14 over 60 days: seven days on either side, the two ends by half.
_ES = """(SELECT metric_name, day, value, row_number() OVER (PARTITION BY metric_name ORDER BY day) - 1 AS i, count(*) OVER (PARTITION BY metric_name) AS n
    FROM (SELECT l_returnflag AS metric_name, date '2024-01-01' + CAST(date_diff('day', date '1995-01-01', CAST(l_shipdate AS DATE)) % 60 AS INT) AS day,
    avg(l_quantity) AS value FROM lineitem GROUP BY 1, 2))"""
_ET = f"""(SELECT *, CASE WHEN i >= 7 AND i < n - 7 THEN (sum(value) OVER (PARTITION BY metric_name ORDER BY i ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)
    + (lag(value, 7) OVER (PARTITION BY metric_name ORDER BY i) + lead(value, 7) OVER (PARTITION BY metric_name ORDER BY i)) / 2) / 14 END AS inner_trend FROM {_ES})"""
_EFIT = f"""(SELECT metric_name, regr_slope(y1, i) AS hs, regr_intercept(y1, i) AS hi, regr_slope(y2, i) AS s2, regr_intercept(y2, i) AS i2
    FROM (SELECT *, CASE WHEN i >= 7 AND i < 20 THEN inner_trend END AS y1, CASE WHEN i >= n - 21 AND i < n - 8 THEN inner_trend END AS y2
    FROM {_ET}) GROUP BY 1)"""
_ED = f"""(SELECT t.metric_name, day, value, i, CASE WHEN i < 7 THEN hs * i + hi WHEN i > n - 8 THEN s2 * i + i2 ELSE inner_trend END AS trend
    FROM {_ET} t JOIN {_EFIT} f USING (metric_name))"""
_EPH = f"(SELECT metric_name, i % 14 AS phase, avg(value - trend) AS m FROM {_ED} GROUP BY 1, 2)"
add("w08_decompose_even", lambda d: t.decompose(_long_series(d), "metric_name", period=14),
    f"""SELECT d.metric_name, day, value, 14 AS period, trend, s.m - g.m AS seasonal, value - trend - (s.m - g.m) AS resid FROM {_ED} d
    JOIN {_EPH} s ON s.metric_name = d.metric_name AND s.phase = d.i % 14
    JOIN (SELECT metric_name, avg(m) AS m FROM {_EPH} GROUP BY 1) g ON g.metric_name = d.metric_name""", "value trend seasonal resid")
add("w09_trend_slope", lambda d: t.trend_slope(t.decompose(_series(d), "metric_name"), "metric_name"),
    f"""SELECT *, CASE WHEN trend_slope > 0.1 THEN 'increasing' WHEN trend_slope < -0.1 THEN 'decreasing' ELSE 'stable' END AS trend_direction
        FROM (SELECT metric_name, (arg_max(trend, day) - arg_min(trend, day)) / count(*) AS trend_slope,
        max(seasonal) - min(seasonal) AS seasonal_amplitude, max(period) AS period_used FROM ({_DECOMPOSED}) GROUP BY 1)""",
    "trend_slope seasonal_amplitude")
add("w10_last_n", lambda d: t.last_n(d.history(), "timestamp", 168, ties=["event_id"]),
    "SELECT * FROM history ORDER BY timestamp DESC, event_id DESC LIMIT 168", "pm25 temperature humidity")
add("w10_last_n_by_sensor", lambda d: t.last_n(d.history(), "timestamp", 3, "native_sensor_id", ["event_id"]),
    """SELECT event_id, timestamp, native_sensor_id, pm25, temperature, humidity FROM (SELECT *, row_number() OVER (
       PARTITION BY native_sensor_id ORDER BY timestamp DESC, event_id DESC) AS rn FROM history) WHERE rn <= 3""",
    "pm25 temperature humidity")
_WEEKS = """SELECT native_sensor_id, metric_name, c.current_avg, p.previous_avg, 
    round(round(c.current_avg - p.previous_avg, 8)::DECIMAL(24,8), 2)::DOUBLE AS change,
    round(round((c.current_avg - p.previous_avg) / nullif(p.previous_avg, 0) * 100, 8)::DECIMAL(24,8), 1)::DOUBLE AS percent_change FROM
    (SELECT native_sensor_id, metric_name, avg(avg_value) AS current_avg FROM enriched WHERE day_ts >= '2024-01-24' GROUP BY 1, 2) c
    JOIN (SELECT native_sensor_id, metric_name, avg(avg_value) AS previous_avg FROM enriched
      WHERE day_ts >= '2024-01-17' AND day_ts < '2024-01-24' GROUP BY 1, 2) p USING (native_sensor_id, metric_name)"""
add("w11_week_over_week", lambda d: t.week_over_week(d.enriched(), "2024-01-31"), _WEEKS,
    "current_avg previous_avg change percent_change")

# --- seasonal statistics ---
_CAL = lambda kind, period: f"""SELECT '{kind}' AS kind, {period} AS period, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
    max(value) AS max, count(*)::BIGINT AS count FROM pm_days GROUP BY 2"""
_SEASON = """CASE WHEN month(day) IN (12, 1, 2) THEN 'winter' WHEN month(day) IN (3, 4, 5) THEN 'spring'
    WHEN month(day) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END"""


def _pm_days(d):
    return t.daily_means(d.history(), "timestamp", "pm25")


add("a27_calendar_stats", lambda d: t.calendar_stats(d.history(), "timestamp", "pm25"),
    _CAL("month", "CAST(month(day) AS VARCHAR)") + " UNION ALL " + _CAL("season", _SEASON), "mean std min max")
_HIGH = "(SELECT *, (SELECT quantile_cont(value, 0.75) FROM pm_days) AS threshold FROM pm_days)"
add("a28_high_days", lambda d: t.high_days(_pm_days(d))[0],
    f"""SELECT max(threshold) AS threshold, count(*) FILTER (value > threshold)::BIGINT AS total_high_days,
        100.0::DOUBLE * count(*) FILTER (value > threshold) / count(*) AS percentage_high_days FROM {_HIGH}""", "threshold percentage_high_days")
add("a28_high_days_by_month", lambda d: t.high_days(_pm_days(d))[1],
    f"SELECT month(day)::INT AS month, count(*)::BIGINT AS high_days FROM {_HIGH} WHERE value > threshold GROUP BY 1")
add("a29_overall_stats", lambda d: t.overall_stats(_pm_days(d)),
    """SELECT avg(value) AS mean_pm25, quantile_cont(value, 0.5) AS median_pm25, stddev_samp(value) AS std_pm25, min(value) AS min_pm25,
       max(value) AS max_pm25, CASE WHEN count(*) > 30 THEN 'good' ELSE 'limited' END AS data_quality FROM pm_days""",
    "mean_pm25 median_pm25 std_pm25 min_pm25 max_pm25")
add("a30_trend_change", lambda d: t.trend_change(_pm_days(d)),
    """SELECT r AS recent_average, o AS older_average, r - o AS trend_change, CASE WHEN r - o < -2 THEN 'improving' WHEN r - o > 2 THEN 'worsening'
       ELSE 'stable' END AS trend_direction FROM (SELECT avg(value) FILTER (back <= 7) AS r, avg(value) FILTER (ahead <= 7) AS o FROM
       (SELECT value, row_number() OVER (ORDER BY day) AS ahead, row_number() OVER (ORDER BY day DESC) AS back FROM pm_days))""",
    "recent_average older_average trend_change")
