"""The driver's tables seen as sensor data, in Spark and as DuckDB common table expressions.

Both sides are the same deterministic projections over whole tables: ``lineitem`` is the weather feed,
``events`` the air-quality feed and the history, ``supplier`` gives the dimensions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aeroloom import vocab
from aeroloom.operators import locations, normalize, rollups
from aeroloom.operators.filters import between_days
from aeroloom.plans import views
from aeroloom.session import configure

PROC_DATE = "2024-01-30"
NOW = "2024-01-31 00:00:00"
WEEK_START = "2024-01-24"
DIGITS = 8

WU_FED = ["temperature", "humidity", "precip_rate", "wind_speed_avg"]
TSI_FED = ["pm2_5", "pm10", "pm1_0", "temperature", "humidity"]


class Feeds:
    """Spark side."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def wu(self) -> DataFrame:
        """Weather feed: dates folded into January 2024 and spread over quarter hours; zero tax is no reading."""
        return self.table("lineitem").selectExpr(
            """timestampadd(MINUTE, CAST((l_orderkey % 24)*60 + (l_linenumber % 4)*15 AS INT),
                 timestampadd(DAY, CAST(datediff(l_shipdate, date'1995-01-01') % 30 AS INT),
                   timestamp_ntz'2024-01-01 00:00:00')) AS ts""",
            "concat('KNCDURHA', CAST(l_suppkey AS STRING)) AS native_sensor_id",
            "36.0D + (l_suppkey % 7)*0.01D AS lat", "-78.9D - (l_suppkey % 5)*0.01D AS lon",
            "l_quantity AS temperature", "abs(l_discount)*1000D AS humidity", "nullif(abs(l_tax), 0D) AS precip_rate",
            "floor(l_extendedprice/10)/100D AS wind_speed_avg")

    def tsi(self) -> DataFrame:
        """Air-quality feed: sparse, and every tenth event seen from a shifted position."""
        pick = lambda kind, name: f"CASE WHEN event_type='{kind}' THEN value END AS {name}"
        return self.table("events").selectExpr(
            "ts", "concat('d', CAST(user_id AS STRING)) AS native_sensor_id",
            "36.0D + (user_id % 7)*0.01D + CASE WHEN event_id % 10 = 0 THEN 0.005D ELSE 0D END AS latitude",
            "-78.9D AS longitude", pick("click", "pm2_5"), pick("error", "pm10"), pick("purchase", "pm1_0"),
            pick("signup", "temperature"), pick("view", "humidity"))

    def history(self) -> DataFrame:
        """Dense history: every event is a PM2.5 reading with temperature and humidity."""
        return self.table("events").selectExpr(
            "event_id", "ts AS timestamp", "concat('d', CAST(user_id AS STRING)) AS native_sensor_id", "value AS pm25",
            "CAST(event_id % 70 - 25 AS DOUBLE) AS temperature", "CAST(event_id % 101 AS DOUBLE) AS humidity")

    def sparse(self) -> DataFrame:
        """History with gaps: one critical metric in five readings is missing."""
        return self.history().selectExpr(
            "event_id", "timestamp", "native_sensor_id", "CASE WHEN event_id % 5 <> 0 THEN pm25 END AS pm25",
            "CASE WHEN event_id % 7 <> 0 THEN temperature END AS temperature",
            "CASE WHEN event_id % 11 <> 0 THEN humidity END AS humidity")

    def long(self, metrics=None) -> DataFrame:
        return normalize.union_all(normalize.source_long(self.wu(), "WU", metrics),
                                   normalize.source_long(self.tsi(), "TSI", metrics))

    def wide(self) -> dict[str, DataFrame]:
        return {"WU": self.wu(), "TSI": self.tsi()}

    def hourly(self) -> DataFrame:
        return rollups.rollup_sources(self.wide(), "hour")

    def daily(self, metrics=None) -> DataFrame:
        """Daily rollup of the whole month; of the listed metrics alone, if given."""
        return rollups.rollup_sources(self.wide(), "day", metrics)

    def week(self) -> DataFrame:
        """Daily rollup of the seven days up to the processing date."""
        recent = {s: between_days(df, "ts", WEEK_START, PROC_DATE) for s, df in self.wide().items()}
        return rollups.rollup_sources(recent, "day")

    def id_map(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_name AS sensor_id", "concat('KNCDURHA', CAST(s_suppkey AS STRING)) AS native_sensor_id",
            "CASE WHEN s_suppkey % 2 = 1 THEN date'2024-01-15' END AS effective_start_date",
            "CAST(NULL AS DATE) AS effective_end_date", "'supplier' AS source",
            "timestamp'2024-01-01 00:00:00' AS updated_at")

    def curated(self) -> DataFrame:
        """Curated locations of every third sensor; one in four lacks a coordinate."""
        return self.table("supplier").filter("s_suppkey % 3 = 0").selectExpr(
            "concat('KNCDURHA', CAST(s_suppkey AS STRING)) AS native_sensor_id",
            "CASE WHEN s_suppkey % 4 <> 0 THEN 36.5D + s_suppkey*0.001D END AS latitude", "-79.5D AS longitude",
            "CASE WHEN s_suppkey % 4 <> 0 THEN named_struct('longitude', -79.5D, 'latitude', 36.5D + s_suppkey*0.001D) END AS geog",
            "CASE s_suppkey % 9 WHEN 0 THEN 'active' WHEN 3 THEN 'inactive' END AS status",
            "CASE WHEN s_suppkey % 9 <> 6 THEN date'2023-12-01' END AS effective_date",
            "CASE WHEN s_suppkey % 2 = 0 THEN 'surveyed' END AS notes", "timestamp'2024-01-01 00:00:00' AS updated_at")

    def canonical(self) -> DataFrame:
        return locations.canonical_location(self.wu(), self.tsi(), PROC_DATE)

    def current(self) -> DataFrame:
        return locations.current_locations(rollups.observed_sensors(self.wide()), self.canonical(), self.curated())

    def enriched(self, metrics=None) -> DataFrame:
        return views.enriched(self.daily(metrics), self.id_map(), self.current())

    def sensors(self) -> DataFrame:
        """Star: sensors of both kinds."""
        wu = self.table("supplier").selectExpr("concat('w', s_suppkey) AS sensor_pk", "concat('KNCDURHA', s_suppkey) AS native_sensor_id",
                                               "'WU' AS sensor_type", "s_name AS friendly_name")
        tsi = self.table("events").select("user_id").distinct().selectExpr(
            "concat('t', user_id) AS sensor_pk", "concat('d', user_id) AS native_sensor_id", "'TSI' AS sensor_type",
            "concat('device ', user_id) AS friendly_name")
        return wu.unionByName(tsi)

    def deployments(self) -> DataFrame:
        """Star: one deployment per sensor, ended for keys divisible by eleven."""
        return self.sensors().selectExpr(
            "concat('dep-', sensor_pk) AS deployment_pk", "sensor_pk AS sensor_fk", "concat('site ', sensor_pk) AS location",
            "CAST(NULL AS DOUBLE) AS latitude", "CAST(NULL AS DOUBLE) AS longitude", "'active' AS status",
            "date'2024-01-10' AS start_date",
            "CASE WHEN CAST(substring(sensor_pk, 2) AS BIGINT) % 11 = 0 THEN date'2024-01-20' END AS end_date")

    def star(self) -> DataFrame:
        """Star fact of the air-quality feed."""
        return self.history().selectExpr(
            "timestamp", "concat('dep-t', substring(native_sensor_id, 2)) AS deployment_fk",
            "CASE WHEN event_id % 3 = 0 THEN 'pm25' ELSE 'humidity' END AS metric_name", "pm25 AS value", "event_id")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to the digits both engines agree on; applied last."""
    return df.select([F.round(F.col(f"`{f.name}`"), DIGITS).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                      else F.col(f"`{f.name}`") for f in df.schema])


# --- DuckDB side ---------------------------------------------------------------------------------------


def _unpivot(table: str, lat: str, lon: str, metrics) -> str:
    return " UNION ALL ".join(
        f"SELECT ts AS timestamp, native_sensor_id, '{m}' AS metric_name, {m}::DOUBLE AS value, {lat} AS latitude, "
        f"{lon} AS longitude FROM {table} WHERE ts IS NOT NULL AND {m} IS NOT NULL" for m in metrics)


def _rollup(grain: str, out: str, source: str) -> str:
    return (f"SELECT date_trunc('{grain}', timestamp)::TIMESTAMP AS {out}, native_sensor_id, metric_name, "
            "arg_min(latitude, timestamp) AS latitude, arg_min(longitude, timestamp) AS longitude, avg(value) AS avg_value, "
            f"min(value) AS min_value, max(value) AS max_value, count(*)::BIGINT AS samples FROM {source} GROUP BY 1, 2, 3")


CTES = {
    "wu": """SELECT timestamp '2024-01-01' + to_days(CAST(date_diff('day', date '1995-01-01', CAST(l_shipdate AS DATE)) % 30 AS INT))
          + to_minutes(CAST((l_orderkey % 24)*60 + (l_linenumber % 4)*15 AS INT)) AS ts,
        'KNCDURHA' || CAST(l_suppkey AS VARCHAR) AS native_sensor_id,
        36.0::DOUBLE + (l_suppkey % 7)*0.01::DOUBLE AS lat, -78.9::DOUBLE - (l_suppkey % 5)*0.01::DOUBLE AS lon,
        l_quantity AS temperature, abs(l_discount)*1000::DOUBLE AS humidity, nullif(abs(l_tax), 0::DOUBLE) AS precip_rate,
        floor(l_extendedprice/10)/100::DOUBLE AS wind_speed_avg FROM lineitem""",
    "tsi": """SELECT ts, 'd' || CAST(user_id AS VARCHAR) AS native_sensor_id,
        36.0::DOUBLE + (user_id % 7)*0.01::DOUBLE + CASE WHEN event_id % 10 = 0 THEN 0.005::DOUBLE ELSE 0::DOUBLE END AS latitude,
        -78.9::DOUBLE AS longitude,
        CASE WHEN event_type='click' THEN value END AS pm2_5, CASE WHEN event_type='error' THEN value END AS pm10,
        CASE WHEN event_type='purchase' THEN value END AS pm1_0, CASE WHEN event_type='signup' THEN value END AS temperature,
        CASE WHEN event_type='view' THEN value END AS humidity FROM events""",
    "history": """SELECT event_id, ts AS timestamp, 'd' || CAST(user_id AS VARCHAR) AS native_sensor_id, value AS pm25,
        CAST(event_id % 70 - 25 AS DOUBLE) AS temperature, CAST(event_id % 101 AS DOUBLE) AS humidity FROM events""",
    "sparse": """SELECT event_id, timestamp, native_sensor_id, CASE WHEN event_id % 5 <> 0 THEN pm25 END AS pm25,
        CASE WHEN event_id % 7 <> 0 THEN temperature END AS temperature,
        CASE WHEN event_id % 11 <> 0 THEN humidity END AS humidity FROM history""",
    "long": _unpivot("wu", "lat", "lon", WU_FED) + " UNION ALL " + _unpivot("tsi", "latitude", "longitude", TSI_FED),
    "hourly": _rollup("hour", "hour_ts", "long"),
    "daily": _rollup("day", "day_ts", "long"),
    "week": "SELECT * FROM daily WHERE day_ts >= timestamp '2024-01-24' AND day_ts < timestamp '2024-01-31'",
    "id_map": """SELECT s_name AS sensor_id, 'KNCDURHA' || CAST(s_suppkey AS VARCHAR) AS native_sensor_id,
        CASE WHEN s_suppkey % 2 = 1 THEN date '2024-01-15' END AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date,
        'supplier' AS source, timestamp '2024-01-01 00:00:00' AS updated_at FROM supplier""",
    "curated": """SELECT 'KNCDURHA' || CAST(s_suppkey AS VARCHAR) AS native_sensor_id,
        CASE WHEN s_suppkey % 4 <> 0 THEN 36.5::DOUBLE + s_suppkey*0.001::DOUBLE END AS latitude, -79.5::DOUBLE AS longitude,
        CASE s_suppkey % 9 WHEN 0 THEN 'active' WHEN 3 THEN 'inactive' END AS status,
        CASE WHEN s_suppkey % 9 <> 6 THEN date '2023-12-01' END AS effective_date,
        CASE WHEN s_suppkey % 2 = 0 THEN 'surveyed' END AS notes, timestamp '2024-01-01 00:00:00' AS updated_at
        FROM supplier WHERE s_suppkey % 3 = 0""",
    "places": """SELECT DISTINCT native_sensor_id, CAST(ts AS DATE) AS day, round(lat, 5) AS lat_r, round(lon, 5) AS lon_r FROM wu
        WHERE ts >= timestamp '2023-11-02' AND ts < timestamp '2024-01-31'
        UNION SELECT DISTINCT native_sensor_id, CAST(ts AS DATE), round(latitude, 5), round(longitude, 5) FROM tsi
        WHERE ts >= timestamp '2023-11-02' AND ts < timestamp '2024-01-31'""",
    "coord_stats": """SELECT native_sensor_id, lat_r, lon_r, count(*)::BIGINT AS days_count, max(day) AS last_day
        FROM places GROUP BY 1, 2, 3""",
    "mode_coord": """SELECT native_sensor_id, lat_r, lon_r, days_count, last_day FROM (SELECT *, row_number() OVER (
        PARTITION BY native_sensor_id ORDER BY days_count DESC, last_day DESC, lat_r, lon_r) AS rn FROM coord_stats) WHERE rn = 1""",
    "place_stats": """SELECT native_sensor_id, count(DISTINCT day)::BIGINT AS days_observed,
        count(DISTINCT (lat_r, lon_r))::BIGINT AS distinct_locations FROM places GROUP BY 1""",
    "canonical": """SELECT m.native_sensor_id, m.lat_r AS canonical_latitude, m.lon_r AS canonical_longitude,
        date '2024-01-30' AS as_of_date, s.days_observed, s.distinct_locations, m.days_count AS coord_mode_count,
        m.last_day AS coord_mode_last_day FROM mode_coord m LEFT JOIN place_stats s USING (native_sensor_id)""",
    "current_loc": """SELECT s.native_sensor_id,
        CASE WHEN d.latitude IS NOT NULL AND d.longitude IS NOT NULL THEN d.latitude ELSE c.canonical_latitude END AS latitude,
        CASE WHEN d.latitude IS NOT NULL AND d.longitude IS NOT NULL THEN d.longitude ELSE c.canonical_longitude END AS longitude,
        d.status, d.effective_date, d.notes, d.updated_at
        FROM (SELECT DISTINCT native_sensor_id FROM daily) s LEFT JOIN canonical c USING (native_sensor_id)
        LEFT JOIN curated d USING (native_sensor_id)""",
    "enriched": """SELECT d.day_ts, d.native_sensor_id, coalesce(m.sensor_id, d.native_sensor_id) AS sensor_id, d.metric_name,
        d.metric_name AS metric, d.avg_value AS value, d.avg_value, d.min_value, d.max_value, d.samples, lc.latitude, lc.longitude,
        lc.status, lc.effective_date FROM daily d LEFT JOIN id_map m ON d.native_sensor_id = m.native_sensor_id
        AND (m.effective_start_date IS NULL OR CAST(d.day_ts AS DATE) >= m.effective_start_date)
        AND (m.effective_end_date IS NULL OR CAST(d.day_ts AS DATE) <= m.effective_end_date)
        LEFT JOIN current_loc lc ON d.native_sensor_id = lc.native_sensor_id""",
    "tsi_list": """SELECT DISTINCT native_sensor_id FROM daily WHERE metric_name IN ('pm2_5', 'pm1_0', 'pm10') AND samples > 0""",
    "wu_list": """SELECT DISTINCT native_sensor_id FROM daily WHERE native_sensor_id LIKE 'KNCDURHA%' OR native_sensor_id LIKE 'KNCDURHM%'
        OR native_sensor_id IN (SELECT DISTINCT native_sensor_id FROM daily
          WHERE metric_name IN ('solar_radiation', 'wind_speed_avg', 'precip_total') AND samples > 0
          AND native_sensor_id NOT IN (SELECT native_sensor_id FROM tsi_list))""",
    "all_enriched": """SELECT e.*, 'TSI' AS sensor_source, 'Air Quality' AS sensor_category FROM enriched e JOIN tsi_list USING (native_sensor_id)
        WHERE samples > 0 UNION ALL SELECT e.*, 'WU', 'Weather' FROM enriched e JOIN wu_list USING (native_sensor_id) WHERE samples > 0""",
    "sensors": """SELECT 'w' || s_suppkey AS sensor_pk, 'KNCDURHA' || s_suppkey AS native_sensor_id, 'WU' AS sensor_type,
        s_name AS friendly_name FROM supplier UNION ALL SELECT DISTINCT 't' || user_id, 'd' || user_id, 'TSI', 'device ' || user_id FROM events""",
    "deployments": """SELECT 'dep-' || sensor_pk AS deployment_pk, sensor_pk AS sensor_fk, 'site ' || sensor_pk AS location,
        CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, 'active' AS status, date '2024-01-10' AS start_date,
        CASE WHEN CAST(substr(sensor_pk, 2) AS BIGINT) % 11 = 0 THEN date '2024-01-20' END AS end_date FROM sensors""",
    "star": """SELECT timestamp, 'dep-t' || substr(native_sensor_id, 2) AS deployment_fk,
        CASE WHEN event_id % 3 = 0 THEN 'pm25' ELSE 'humidity' END AS metric_name, pm25 AS value, event_id FROM history""",
    "pm_days": "SELECT CAST(timestamp AS DATE) AS day, avg(pm25) AS value FROM history WHERE pm25 IS NOT NULL GROUP BY 1",
}


def _needed(text: str, done: list[str]) -> None:
    for name in CTES:
        if name not in done and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
            _needed(CTES[name], done)
            done.append(name)


def oracle(body: str, doubles: str = "") -> str:
    """Complete query: the expressions ``body`` refers to, and the named double columns rounded at the end."""
    extra = ""
    if body.lstrip().upper().startswith("WITH "):
        raise ValueError("use inline subqueries")
    needed: list[str] = []
    _needed(body, needed)
    if needed:
        extra = "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in needed) + " "
    names = doubles.split()
    if names:
        return (f"{extra}SELECT * REPLACE (" + ", ".join(f"round({n}::DOUBLE, {DIGITS}) AS {n}" for n in names)
                + f") FROM ({body})")
    return extra + body
