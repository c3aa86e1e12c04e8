"""Enriched views: source lists, identity and location on the rollups and on the long fact."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from aeroloom import vocab
from aeroloom.operators import filters, joins, locations, normalize, reports

DAILY_COLUMNS = ["day_ts", "native_sensor_id", "sensor_id", "metric_name", "metric", "value", "avg_value", "min_value",
                 "max_value", "samples", "latitude", "longitude", "geog", "status", "effective_date"]


_TSI, _WEATHER = 1, 2


def _marks() -> Column:
    """What the rows of a sensor report: bit 1 particulate metrics, bit 2 weather metrics."""
    seen = lambda metrics, bit: F.when((F.col("samples") > 0) & F.col("metric_name").isin(list(metrics)), bit).otherwise(0)
    return F.bit_or(seen(vocab.TSI_MARKER_METRICS, _TSI).bitwiseOR(seen(vocab.WU_MARKER_METRICS, _WEATHER)))


def _marked_sensors(daily: DataFrame) -> DataFrame:
    """Every sensor with its marks, from one pass over the rollup."""
    return daily.groupBy("native_sensor_id").agg(_marks().alias("marks"))


def _has(bit: int):
    return F.col("marks").bitwiseAND(bit) == bit


def _weather_station(marked: DataFrame):
    """Named like a weather station, or reporting weather ``NOT IN`` the air-quality sensors, with that rule's nulls: a null among
    those empties it, and a null sensor passes only if there are none."""
    key = F.col("native_sensor_id")
    # Reads both columns as its caller does, so that Spark aggregates the sensors once for both.
    facts = marked.agg(F.struct(F.count_if(key.isNull() & _has(_TSI)).alias("nulls"), F.count_if(_has(_TSI)).alias("size"))).scalar()
    other = _has(_WEATHER) & ~_has(_TSI) & (facts["nulls"] == 0) & (key.isNotNull() | (facts["size"] == 0))
    return _named_station() | other


def _named_station() -> Column:
    named = reduce(or_, [F.col("native_sensor_id").startswith(p) for p in vocab.WU_ID_PREFIXES])
    return F.coalesce(named, F.lit(False))


def tsi_sensor_list(daily: DataFrame) -> DataFrame:
    """Sensors that report particulate metrics."""
    return _marked_sensors(daily).filter(_has(_TSI)).select("native_sensor_id")


def wu_sensor_list(daily: DataFrame) -> DataFrame:
    """Sensors named like weather stations, or reporting weather metrics without being air-quality sensors."""
    marked = _marked_sensors(daily)
    return marked.filter(_weather_station(marked)).select("native_sensor_id")


def _sensor_kinds(daily: DataFrame, kinds) -> DataFrame:
    """A row (native_sensor_id and the columns of its kind) per sensor and list it is in; ``kinds`` has the values of the air-quality and the weather list."""
    marked = _marked_sensors(daily)
    lists = F.array(F.when(_has(_TSI), kinds[0]), F.when(_weather_station(marked), kinds[1]))
    found = marked.select("native_sensor_id", F.explode(lists).alias("kind"))
    return found.filter(F.col("kind").isNotNull()).select("native_sensor_id", "kind.*")


def classify_sources(daily: DataFrame) -> DataFrame:
    """(native_sensor_id, sensor_source); a sensor in both lists has two rows."""
    return _sensor_kinds(daily, [F.struct(F.lit(s).alias("sensor_source")) for s in ("TSI", "WU")])


def _located(df: DataFrame, current: DataFrame) -> DataFrame:
    dim = current.select("native_sensor_id", "latitude", "longitude", "geog", "status", "effective_date")
    return df.drop("latitude", "longitude", "geog").join(dim, "native_sensor_id", "left")


def enriched(daily: DataFrame, id_map: DataFrame, current: DataFrame, sensors: DataFrame | None = None,
             on_overlap: str = "fan_out") -> DataFrame:
    """Daily rollup with stable id, current location and lifecycle; only ``sensors`` when given."""
    rows = daily if sensors is None else joins.keep_sensors(filters.has_samples(daily), sensors)
    return _attached(rows, id_map, current, on_overlap).select(DAILY_COLUMNS)


def _attached(rows: DataFrame, id_map: DataFrame, current: DataFrame, on_overlap: str = "fan_out") -> DataFrame:
    mapped = joins.map_sensor_id(rows, id_map, "day_ts", on_overlap)
    return _located(mapped, current).withColumns({"metric": F.col("metric_name"), "value": F.col("avg_value")})


def long_enriched(long_df: DataFrame, id_map: DataFrame, current: DataFrame, on_overlap: str = "fan_out") -> DataFrame:
    mapped = joins.map_sensor_id(long_df, id_map, "timestamp", on_overlap)
    return _located(mapped, current).select(
        "timestamp", "native_sensor_id", "sensor_id", "metric_name", "value", "latitude", "longitude", "geog",
        "status", "effective_date")


def tsi_daily_enriched(daily: DataFrame, id_map: DataFrame, current: DataFrame) -> DataFrame:
    return normalize.tag_source(enriched(daily, id_map, current, tsi_sensor_list(daily)), "TSI", "Air Quality")


def wu_daily_enriched(daily: DataFrame, id_map: DataFrame, current: DataFrame) -> DataFrame:
    return normalize.tag_source(enriched(daily, id_map, current, wu_sensor_list(daily)), "WU", "Weather")


def all_daily_enriched(daily: DataFrame, id_map: DataFrame, current: DataFrame) -> DataFrame:
    """Enriched rows of both kinds; a sensor in both lists has its rows twice, one in neither, or without an id, none.

    A sensor's rows, no more than its days and metrics, are marked where they meet for the joins, so the rollup is run once; only
    its rows without an id are looked for beside it, since a null among the air-quality sensors empties ``NOT IN``.
    """
    key, sampled = F.col("native_sensor_id"), filters.has_samples(daily)
    marked = sampled.withColumn("marks", _marks().over(Window.partitionBy("native_sensor_id")))
    nulls = sampled.filter(key.isNull()).agg(_marks().alias("marks")).select(F.coalesce(_has(_TSI), F.lit(False))).scalar()
    station = _named_station() | (_has(_WEATHER) & ~_has(_TSI) & ~nulls)
    kind = lambda source, category: F.struct(F.lit(source).alias("sensor_source"), F.lit(category).alias("sensor_category"))
    kinds = F.array(F.when(key.isNotNull() & _has(_TSI), kind("TSI", "Air Quality")), F.when(key.isNotNull() & station, kind("WU", "Weather")))
    rows = _attached(marked.withColumn("kinds", kinds), id_map, current).withColumn("kind", F.explode("kinds"))
    return rows.filter(F.col("kind").isNotNull()).select(*DAILY_COLUMNS, "kind.*")


def metric_subset_view(daily: DataFrame, id_map: DataFrame, current: DataFrame, metrics, sensor_type: str) -> DataFrame:
    """Older per-type view: enriched rows of a fixed metric list."""
    return enriched(filters.metric_in(daily, metrics), id_map, current).withColumn("sensor_type", F.lit(sensor_type))


def serving_views(long_df: DataFrame, daily: DataFrame, id_map: DataFrame, canonical: DataFrame,
                  curated: DataFrame) -> dict[str, DataFrame]:
    """All views by name, ready for ``register_views``."""
    latest = locations.canonical_latest(canonical)
    current = locations.current_locations(long_df, latest, curated)
    combined = all_daily_enriched(daily, id_map, current)
    return {
        "sensor_canonical_latest": latest, "sensor_location_current": current,
        "sensor_readings_daily_enriched": enriched(daily, id_map, current),
        "sensor_readings_long_enriched": long_enriched(long_df, id_map, current),
        "tsi_sensor_list": tsi_sensor_list(daily), "wu_sensor_list": wu_sensor_list(daily),
        "tsi_daily_enriched": tsi_daily_enriched(daily, id_map, current),
        "wu_daily_enriched": wu_daily_enriched(daily, id_map, current),
        "all_sensors_daily_enriched": combined, "sensor_source_summary": reports.source_summary(combined)}
