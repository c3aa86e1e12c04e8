"""Sorting, limits and set operations (section 2.8)."""

from pyspark.sql import functions as F

from aeroloom.operators import normalize, quality, timeseries as t
from aeroloom.sources.catalogs import manifest_df
from aeroloom.vocab import MANIFEST
from verification.registry import add

_ALL = sorted({m for v in MANIFEST.values() for m in v["metrics"]})
_VALUES = "(SELECT unnest([" + ", ".join(f"'{m}'" for m in _ALL) + "]) AS metric_name)"

add("o01_order_by", lambda d: t.order_by(d.daily().select("native_sensor_id", "metric_name", "day_ts", "avg_value"),
                                         F.desc(F.abs(F.col("avg_value"))), "native_sensor_id"),
    "SELECT native_sensor_id, metric_name, day_ts, avg_value FROM daily ORDER BY abs(avg_value) DESC, native_sensor_id", "avg_value")
add("o02_latest_n", lambda d: t.latest_n(d.history(), "timestamp", 5, ties=["event_id"]),
    "SELECT * FROM history ORDER BY timestamp DESC, event_id DESC LIMIT 5", "pm25 temperature humidity")
add("o04_head_tail", lambda d: t.head_tail(d.history(), "timestamp", 7, ties=["event_id"]),
    """(SELECT *, 'head' AS part FROM history ORDER BY timestamp, event_id LIMIT 7) UNION ALL
       (SELECT *, 'tail' AS part FROM history ORDER BY timestamp DESC, event_id DESC LIMIT 7)""", "pm25 temperature humidity")
add("o04_head_tail_by_sensor", lambda d: t.head_tail(d.history(), "timestamp", 2, "native_sensor_id", ["event_id"]),
    """SELECT event_id, timestamp, native_sensor_id, pm25, temperature, humidity, 'head' AS part FROM (SELECT *, row_number() OVER (
         PARTITION BY native_sensor_id ORDER BY timestamp, event_id) AS rn FROM history) WHERE rn <= 2 UNION ALL
       SELECT event_id, timestamp, native_sensor_id, pm25, temperature, humidity, 'tail' FROM (SELECT *, row_number() OVER (
         PARTITION BY native_sensor_id ORDER BY timestamp DESC, event_id DESC) AS rn FROM history) WHERE rn <= 2""", "pm25 temperature humidity")
add("o05_union_all",
    lambda d: normalize.union_all(d.wu().select("ts", "native_sensor_id", "temperature", "wind_speed_avg"),
                                  d.tsi().select("ts", "native_sensor_id", "temperature", "pm2_5")),
    """SELECT ts, native_sensor_id, temperature, wind_speed_avg, NULL::DOUBLE AS pm2_5 FROM wu UNION ALL
       SELECT ts, native_sensor_id, temperature, NULL::DOUBLE, pm2_5 FROM tsi""", "temperature wind_speed_avg pm2_5")
add("o06_union_distinct",
    lambda d: normalize.union_distinct(d.long().select("native_sensor_id"), d.daily().select("native_sensor_id")),
    "SELECT native_sensor_id FROM long UNION SELECT native_sensor_id FROM daily")
add("o07_present_expected",
    lambda d: quality.present_expected(d.long(), manifest_df(d.spark)),
    f"SELECT metric_name FROM long INTERSECT SELECT metric_name FROM {_VALUES}")
add("o08_set_diff",
    lambda d: quality.set_diff(manifest_df(d.spark).select("metric_name"), d.long().select("metric_name")),
    f"SELECT metric_name FROM {_VALUES} EXCEPT SELECT metric_name FROM long")
