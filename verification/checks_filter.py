"""Predicates (section 2.4)."""

from pyspark.sql import functions as F

from aeroloom.operators import filters as f
from verification.feeds import PROC_DATE
from verification.registry import add

_DAY = "day_ts, native_sensor_id, metric_name, avg_value, samples"
_day = ["day_ts", "native_sensor_id", "metric_name", "avg_value", "samples"]

add("f01_on_day", lambda d: f.on_day(d.tsi(), "ts", PROC_DATE).select("ts", "native_sensor_id", "pm2_5"),
    "SELECT ts, native_sensor_id, pm2_5 FROM tsi WHERE CAST(ts AS DATE) = date '2024-01-30'", "pm2_5")
add("f02_between_days", lambda d: f.between_days(d.tsi(), "ts", "2024-01-24", PROC_DATE).select("ts", "native_sensor_id", "pm2_5"),
    "SELECT ts, native_sensor_id, pm2_5 FROM tsi WHERE CAST(ts AS DATE) BETWEEN date '2024-01-24' AND date '2024-01-30'", "pm2_5")
add("f03_require", lambda d: f.require(d.tsi(), ["ts", "latitude", "pm2_5"]).select("ts", "native_sensor_id", "pm2_5"),
    "SELECT ts, native_sensor_id, pm2_5 FROM tsi WHERE ts IS NOT NULL AND latitude IS NOT NULL AND pm2_5 IS NOT NULL", "pm2_5")
add("f04_metric_in", lambda d: f.metric_in(d.daily(), ["pm2_5", "humidity"]).select(_day),
    f"SELECT {_DAY} FROM daily WHERE metric_name IN ('pm2_5', 'humidity')", "avg_value")
add("f05_id_prefix", lambda d: f.id_prefix(d.daily(), ["KNCDURHA", "KNCDURHM"]).select(_day),
    f"SELECT {_DAY} FROM daily WHERE native_sensor_id LIKE 'KNCDURHA%' OR native_sensor_id LIKE 'KNCDURHM%'", "avg_value")
add("f06_in_set", lambda d: f.in_set(d.daily().select(_day), d.curated(), "native_sensor_id").select(_day),
    f"SELECT {_DAY} FROM daily WHERE native_sensor_id IN (SELECT native_sensor_id FROM curated)", "avg_value")
add("f06_not_in_set", lambda d: f.in_set(d.daily().select(_day), d.curated(), "native_sensor_id", negate=True).select(_day),
    f"SELECT {_DAY} FROM daily WHERE native_sensor_id NOT IN (SELECT native_sensor_id FROM curated)", "avg_value")
add("f07_has_samples", lambda d: f.has_samples(d.daily()).select(_day), f"SELECT {_DAY} FROM daily WHERE samples > 0", "avg_value")
add("f08_active_or_unknown", lambda d: f.active_or_unknown(d.enriched()).select(*_day, "status"),
    f"SELECT {_DAY}, status FROM enriched WHERE status = 'active' OR status IS NULL", "avg_value")
add("f09_plausible", lambda d: f.plausible(d.sparse()),
    """SELECT * FROM sparse WHERE pm25 >= 0 AND pm25 <= 1000 AND temperature >= -50 AND temperature <= 60
       AND humidity >= 0 AND humidity <= 100""", "pm25 temperature humidity")
add("f10_utc_day", lambda d: f.utc_day(d.history(), "timestamp", "2024-01-15"),
    "SELECT * FROM history WHERE timestamp >= timestamp '2024-01-15' AND timestamp < timestamp '2024-01-16'", "pm25 temperature humidity")
add("f11_at_latest", lambda d: f.at_latest(d.daily(), "day_ts").select(_day),
    f"SELECT {_DAY} FROM daily WHERE day_ts = (SELECT max(day_ts) FROM daily)", "avg_value")
add("f12_having", lambda d: f.having(d.daily().groupBy("native_sensor_id").agg(F.sum("samples").alias("total")), F.col("total") > 500),
    "SELECT native_sensor_id, sum(samples)::BIGINT AS total FROM daily GROUP BY 1 HAVING sum(samples) > 500")
add("f13_where_case", lambda d: f.where_case(d.daily(), F.when(F.col("samples") < 5, "LOW").otherwise("FULL"), "LOW").select(_day),
    f"SELECT {_DAY} FROM daily WHERE CASE WHEN samples < 5 THEN 'LOW' ELSE 'FULL' END = 'LOW'", "avg_value")
add("f14_any_bound", lambda d: f.any_bound(d.daily(), [("temperature", "max_value", ">=", 49.0), ("humidity", "avg_value", ">=", 90.0),
                                                      ("pm2_5", "min_value", "<=", 1.0)]).select(*_day, "min_value", "max_value"),
    f"""SELECT {_DAY}, min_value, max_value FROM daily WHERE (metric_name = 'temperature' AND max_value >= 49)
        OR (metric_name = 'humidity' AND avg_value >= 90) OR (metric_name = 'pm2_5' AND min_value <= 1)""", "avg_value min_value max_value")
# Ids starting with d1 play the test sensors; both parts are returned with their side named.
add("f15_split_test", lambda d: _both(*f.split_test(d.history(), ["d1", "d2"])),
    """SELECT native_sensor_id, CASE WHEN native_sensor_id LIKE 'd1%' OR native_sensor_id LIKE 'd2%' THEN 'test' ELSE 'production' END AS side,
       count(*)::BIGINT AS n FROM history GROUP BY 1, 2""")
add("f16_epoch_on_day", lambda d: f.epoch_on_day(_epochs(d), "epoch", "2024-01-10"),
    """SELECT event_id, epoch FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(timestamp) // 1000000
       ELSE epoch_us(timestamp) // 1000 END AS epoch FROM history)
       WHERE epoch BETWEEN 1704844800 AND 1704931199 OR epoch BETWEEN 1704844800000 AND 1704931199999""")
add("f17_drop_incomplete", lambda d: f.drop_incomplete(d.sparse(), ["native_sensor_id", "timestamp", "pm25"]),
    "SELECT * FROM sparse WHERE native_sensor_id IS NOT NULL AND trim(native_sensor_id) <> '' AND timestamp IS NOT NULL AND pm25 IS NOT NULL",
    "pm25 temperature humidity")


def _both(test, production):
    rows = test.withColumn("side", F.lit("test")).unionByName(production.withColumn("side", F.lit("production")))
    return rows.groupBy("native_sensor_id", "side").agg(F.count(F.lit(1)).alias("n"))


def _epochs(d):
    ms = F.unix_millis(F.col("timestamp").cast("timestamp"))
    return d.history().select("event_id", F.when(F.col("event_id") % 2 == 0, F.call_function("div", ms, F.lit(1000).cast("bigint")))
                              .otherwise(ms).alias("epoch"))
