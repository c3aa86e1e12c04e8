"""Sensor catalogue and metric manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aeroloom import vocab
from aeroloom.functions.times import parse_date

_STATION = ("name string, stationId string, id string, friendly_name string, location string, start_date string, "
            "startDate string, latitude string, lat string, longitude string, lon string, active boolean")
_CATALOG = f"wu array<struct<{_STATION}>>, tsi array<struct<{_STATION}>>, id string, active boolean"


def sensor_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Sensors of a configuration file: ``{wu: [...], tsi: [...]}``, or a list of test sensors.

    ``active`` defaults to true; inactive sensors are left out of a test list only.
    """
    raw = spark.read.schema(_CATALOG).json(path, multiLine=True)
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))

    def rows(kind: str) -> DataFrame:
        s = raw.select(F.inline(kind))
        native = F.coalesce("stationId", "id")
        friendly = F.coalesce(blank("friendly_name"), blank("name"), native) if kind == "wu" else native
        place = F.coalesce(blank("location"), friendly) if kind == "wu" else native
        return s.filter(native.isNotNull()).select(
            native.alias("native_sensor_id"), F.lit(kind.upper()).alias("sensor_type"), friendly.alias("friendly_name"),
            place.alias("location"), F.coalesce("latitude", "lat").try_cast("double").alias("latitude"),
            F.coalesce("longitude", "lon").try_cast("double").alias("longitude"),
            parse_date(F.coalesce("start_date", "startDate")).alias("start_date"),
            F.coalesce("active", F.lit(True)).alias("active"))

    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    tests = raw.filter(F.col("id").isNotNull() & F.coalesce("active", F.lit(True))).select(
        F.col("id").alias("native_sensor_id"), text.alias("sensor_type"), F.col("id").alias("friendly_name"),
        F.col("id").alias("location"), number.alias("latitude"), number.alias("longitude"),
        F.lit(None).cast("date").alias("start_date"), F.lit(True).alias("active"))
    return rows("wu").unionByName(rows("tsi")).unionByName(tests)


def manifest_df(spark: SparkSession, manifest=vocab.MANIFEST) -> DataFrame:
    """One row per source and metric."""
    rows = [(s, v["native_id_field"], v["timestamp_field"], m) for s, v in manifest.items() for m in v["metrics"]]
    return spark.createDataFrame(rows, "source string, native_id_field string, timestamp_field string, metric_name string")
