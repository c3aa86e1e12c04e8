"""Sensor locations: canonical position, curated position and the registry of deployments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from aeroloom import vocab
from aeroloom.functions import air
from aeroloom.functions.numbers import round_double
from aeroloom.functions.times import as_date, days_between
from aeroloom.operators.normalize import ensure_columns, float_coords


def positions(df: DataFrame, source: str, start, end, ts: str = "ts") -> DataFrame:
    """Complete (sensor, time, latitude, longitude) rows of one source within the days."""
    pairs = vocab.COORDS[source]
    (lat, _), (lon, _) = pairs
    wide = float_coords(df.filter(days_between(df, ts, start, end)), pairs)
    return (wide.select("native_sensor_id", F.col(ts).alias("timestamp"),
                        F.col(lat).alias("latitude"), F.col(lon).alias("longitude"))
            .filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()))


def daily_positions(df: DataFrame, digits: int = 5, ts: str = "timestamp") -> DataFrame:
    """Distinct rounded positions per sensor and day."""
    return df.select("native_sensor_id", F.to_date(ts).alias("day"),
                     round_double(F.col("latitude"), digits).alias("lat_r"), round_double(F.col("longitude"), digits).alias("lon_r")).distinct()


def coord_stats(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("native_sensor_id", "lat_r", "lon_r")
            .agg(F.count(F.lit(1)).alias("days_count"), F.max("day").alias("last_day")))


def top_mode(stats: DataFrame, key: str, order) -> DataFrame:
    """First row per key in ``order``; Spark keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return stats.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def mode_coord(daily: DataFrame) -> DataFrame:
    """Most frequent position per sensor; ties go to the most recent, then to the smaller coordinates."""
    return top_mode(coord_stats(daily), "native_sensor_id",
                    [F.desc("days_count"), F.desc("last_day"), F.asc("lat_r"), F.asc("lon_r")])


def window_stats(daily: DataFrame) -> DataFrame:
    """Days observed and distinct positions per sensor."""
    return daily.groupBy("native_sensor_id").agg(
        F.count_distinct("day").alias("days_observed"),
        F.count_distinct(F.struct("lat_r", "lon_r")).alias("distinct_locations"))


def canonical_location(wu: DataFrame, tsi: DataFrame, proc_date, days: int = 90, digits: int = 5) -> DataFrame:
    """Canonical position per sensor over the ``days`` days up to ``proc_date``."""
    start = as_date(proc_date) - dt.timedelta(days=days - 1)
    seen = positions(wu, "WU", start, proc_date).unionByName(positions(tsi, "TSI", start, proc_date))
    daily = daily_positions(seen, digits)
    return (mode_coord(daily).join(window_stats(daily), "native_sensor_id", "left").select(
        "native_sensor_id", F.col("lat_r").alias("canonical_latitude"), F.col("lon_r").alias("canonical_longitude"),
        air.geo_point(F.col("lat_r"), F.col("lon_r")).alias("canonical_geog"),
        F.lit(as_date(proc_date)).alias("as_of_date"), "days_observed", "distinct_locations",
        F.col("days_count").alias("coord_mode_count"), F.col("last_day").alias("coord_mode_last_day")))


def latest_per_key(df: DataFrame, key, order) -> DataFrame:
    """Latest row per key."""
    return top_mode(df, key, order)


def canonical_latest(canonical: DataFrame) -> DataFrame:
    return latest_per_key(canonical, "native_sensor_id", [F.desc("as_of_date")])


def current_locations(sensors: DataFrame, canonical: DataFrame, curated: DataFrame) -> DataFrame:
    """Every observed sensor with its curated position, or else its canonical one.

    A position is taken as a whole: a curated row that lacks a coordinate does not mix with the other source.
    """
    c = canonical.select("native_sensor_id", F.struct(
        F.col("canonical_latitude").alias("latitude"), F.col("canonical_longitude").alias("longitude")).alias("derived"))
    whole = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    d = curated.select("native_sensor_id", F.when(whole, F.struct("latitude", "longitude")).alias("curated"),
                       "status", "effective_date", "notes", "updated_at")
    joined = (sensors.select("native_sensor_id").distinct()
              .join(c, "native_sensor_id", "left").join(d, "native_sensor_id", "left")
              .withColumn("point", F.coalesce("curated", "derived")))
    return joined.select(
        "native_sensor_id", "point.latitude", "point.longitude",
        air.geo_point(F.col("point.latitude"), F.col("point.longitude")).alias("geog"),
        "status", "effective_date", "notes", "updated_at")


def upsert_location(dim: DataFrame, updates: DataFrame, now) -> DataFrame:
    """Curated location after an update of coordinates and notes; a status or effective date already set stays.

    ``updates`` has one row per sensor: native_sensor_id, latitude, longitude, notes.
    """
    u = updates.select("native_sensor_id", F.struct("latitude", "longitude", "notes").alias("u"))
    j = dim.join(u, "native_sensor_id", "full")
    hit = F.col("u").isNotNull()
    lat = F.when(hit, F.col("u.latitude")).otherwise(F.col("latitude"))
    lon = F.when(hit, F.col("u.longitude")).otherwise(F.col("longitude"))
    now = F.lit(str(now)).cast("timestamp")
    return j.select(
        "native_sensor_id", lat.alias("latitude"), lon.alias("longitude"), air.geo_point(lat, lon).alias("geog"),
        F.when(hit, F.coalesce("status", F.lit("active"))).otherwise(F.col("status")).alias("status"),
        F.when(hit, F.coalesce("effective_date", F.to_date(now))).otherwise(F.col("effective_date")).alias("effective_date"),
        F.when(hit, F.col("u.notes")).otherwise(F.col("notes")).alias("notes"),
        F.when(hit, now).otherwise(F.col("updated_at").cast("timestamp")).alias("updated_at"))


def upsert_status(dim: DataFrame, daily: DataFrame, now, parity: bool = False) -> DataFrame:
    """Mark every observed sensor active, keeping coordinates that are set.

    By default a status already set stays, so a retired sensor is not revived; ``parity=True`` sets all.
    """
    # The earliest point, ties going to the smaller coordinates; points are counted down to a few per sensor first.
    points = daily.groupBy("native_sensor_id", "latitude", "longitude").agg(F.min("day_ts").alias("since"))
    whole = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    seen = (points.groupBy("native_sensor_id")
            .agg(F.min(F.when(whole, F.struct("since", "latitude", "longitude"))).alias("first"))
            .select("native_sensor_id", F.col("first.latitude").alias("seen_lat"), F.col("first.longitude").alias("seen_lon"),
                    F.lit(True).alias("hit")))
    j = dim.join(seen, "native_sensor_id", "full")
    now = F.lit(str(now)).cast("timestamp")
    revive = F.coalesce("hit", F.lit(False)) & (F.lit(parity) | F.col("status").isNull())
    has_point = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    lat = F.when(has_point, F.col("latitude")).otherwise(F.col("seen_lat"))
    lon = F.when(has_point, F.col("longitude")).otherwise(F.col("seen_lon"))
    hit = F.coalesce("hit", F.lit(False))
    return j.select(
        "native_sensor_id", lat.alias("latitude"), lon.alias("longitude"), air.geo_point(lat, lon).alias("geog"),
        F.when(revive, "active").otherwise(F.col("status")).alias("status"),
        F.when(revive, F.to_date(now)).otherwise(F.col("effective_date")).alias("effective_date"),
        F.when(hit, "Auto-populated from sensor_readings_daily").otherwise(F.col("notes")).alias("notes"),
        F.when(hit, now).otherwise(F.col("updated_at").cast("timestamp")).alias("updated_at"))


def seed_missing(dim: DataFrame, candidates: DataFrame, key: str, now) -> DataFrame:
    """The dimension plus the candidates it lacks; columns the candidates do not have are null."""
    dim = dim.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    new = candidates.join(dim.select(key), key, "left_anti").withColumn("updated_at", F.lit(str(now)).cast("timestamp"))
    return dim.unionByName(ensure_columns(new, dim.schema).select(dim.columns))


def location_candidates(canonical: DataFrame) -> DataFrame:
    """Canonical positions as rows of the curated dimension."""
    return canonical.select("native_sensor_id", F.col("canonical_latitude").alias("latitude"),
                            F.col("canonical_longitude").alias("longitude"), F.col("canonical_geog").alias("geog"),
                            F.lit("seeded from canonical").alias("notes"))


def identity_candidates(*facts: DataFrame) -> DataFrame:
    """Observed native ids mapped to themselves."""
    ids = None
    for f in facts:
        part = f.select("native_sensor_id")
        ids = part if ids is None else ids.unionByName(part)
    return ids.distinct().select(F.col("native_sensor_id").alias("sensor_id"), "native_sensor_id",
                                 F.lit("seed:identity").alias("source"))


def surrogate(*cols, algo: str = "xxhash64"):
    """Stable surrogate key of a natural key."""
    return air.row_id(*cols, algo=algo)


def maintain_deployments(sensors: DataFrame, deployments: DataFrame, catalog: DataFrame, first_seen: DataFrame,
                         today, algo: str = "xxhash64") -> tuple[DataFrame, DataFrame]:
    """(sensors, deployments) after taking in the catalogue and the data.

    New sensors are created and renamed ones updated; a sensor without an open deployment gets one; an open
    deployment follows the catalogue's location and moves its start earlier when earlier data appear.
    ``first_seen`` has native_sensor_id, sensor_type, first_date.  Sensors seen only in the data are named
    after their id.
    """
    today = F.lit(as_date(today))
    keys = ["native_sensor_id", "sensor_type"]
    catalog = catalog.withColumn("in_catalog", F.lit(True))
    wanted = (catalog.join(first_seen, keys, "full").select(
        *keys,
        F.coalesce(F.nullif(F.trim("friendly_name"), F.lit("")), "native_sensor_id").alias("new_name"),
        F.coalesce(F.nullif(F.trim("location"), F.lit("")), F.nullif(F.trim("friendly_name"), F.lit("")),
                   "native_sensor_id").alias("new_location"),
        F.col("latitude").alias("new_lat"), F.col("longitude").alias("new_lon"),
        # A sensor of the catalogue starts today unless it says otherwise; data may move that earlier.
        F.least(F.when(F.col("in_catalog"), F.coalesce("start_date", today)), "first_date").alias("new_start")))
    merged = sensors.join(wanted.select(*keys, "new_name"), keys, "full")
    out_sensors = merged.select(
        F.coalesce("sensor_pk", surrogate("sensor_type", "native_sensor_id", algo=algo)).alias("sensor_pk"),
        *keys, F.coalesce("new_name", "friendly_name").alias("friendly_name"))

    keyed = wanted.join(out_sensors.select("sensor_pk", *keys), keys)
    open_, closed = deployments.filter(F.col("end_date").isNull()), deployments.filter(F.col("end_date").isNotNull())
    j = open_.join(keyed.select(F.col("sensor_pk").alias("sensor_fk"), "new_location", "new_lat", "new_lon", "new_start"),
                   "sensor_fk", "full")
    exists = F.col("deployment_pk").isNotNull()
    updated = j.select(
        F.coalesce("deployment_pk", surrogate("sensor_fk", "new_start", algo=algo)).alias("deployment_pk"), "sensor_fk",
        F.coalesce("new_location", "location").alias("location"),
        F.when(exists, F.col("latitude")).otherwise(F.col("new_lat")).alias("latitude"),
        F.when(exists, F.col("longitude")).otherwise(F.col("new_lon")).alias("longitude"),
        F.when(exists, F.col("status")).otherwise("active").alias("status"),
        F.least("start_date", "new_start").alias("start_date"), F.col("end_date"))
    return out_sensors, updated.unionByName(closed.select(updated.columns))
