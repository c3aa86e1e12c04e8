"""Landed JSON payloads of both feeds -> wide rows.

Both parsers work inside one row with built-in functions; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from aeroloom import vocab

#: Objects within an observation; read as maps, where the presence of a field shows.
_NESTED = ("imperial", "metric")
#: As Spark hands on numbers that JSON does not know, when their text is asked for.
_QUOTED = ['"NaN"', '"Infinity"', '"-Infinity"']


def flatten_units(df: DataFrame, obs: str = "observation", fields=None) -> DataFrame:
    """Observation text -> columns; a field of ``imperial`` replaces the top level's, one of ``metric`` both.

    A nested field wins by being present, even when null.  An observation is parsed once, the nested objects with it.
    """
    fields = fields or vocab.WU_FIELD_TYPES
    parsed = df.withColumn("found", F.from_json(obs, _observation(fields)))
    return _picked(parsed, [c for c in df.columns if c != obs], fields)


def _observation(fields) -> T.StructType:
    """What is read of an observation: its own fields as text and the nested objects as maps."""
    text = T.MapType(T.StringType(), T.StringType())
    return T.StructType([*[T.StructField(n, T.StringType()) for n in fields if n not in _NESTED], *[T.StructField(n, text) for n in _NESTED]])


def _picked(parsed: DataFrame, kept, fields) -> DataFrame:
    """The kept columns and the fields of the observation ``found``."""
    imperial, metric = F.col("found.imperial"), F.col("found.metric")

    def pick(name: str, kind: str) -> Column:
        value = (F.when(F.map_contains_key(metric, name), metric[name])
                 .when(F.map_contains_key(imperial, name), imperial[name]).otherwise(F.col("found")[name]))
        value = F.when(value.isin(_QUOTED), F.btrim(value, F.lit('"'))).otherwise(value)
        return (F.try_to_timestamp(value) if kind == "timestamp" else value.try_cast(kind)).alias(name)

    return parsed.select(*kept, *[pick(n, t) for n, t in fields.items()])


def parse_wu_payloads(df: DataFrame, payload: str = "value", station_id: str | None = None, fields=None) -> DataFrame:
    """Responses (one JSON text per row) -> one row per observation.

    A response is parsed once; only one whose list holds something else than objects is taken apart as texts first.
    """
    fields = fields or vocab.WU_FIELD_TYPES
    kept = [c for c in df.columns if c != payload]
    whole = T.StructType([T.StructField("observations", T.ArrayType(_observation(fields)))])
    texts = F.from_json(payload, "observations array<string>")["observations"]
    found = F.coalesce(F.from_json(payload, whole)["observations"], F.transform(texts, lambda o: F.from_json(o, _observation(fields))))
    flat = _picked(df.select(*kept, F.explode(found).alias("found")), kept, fields)
    return flat.withColumn("stationID", F.lit(station_id)) if station_id else flat


def read_wu_json(spark: SparkSession, path: str, station_id: str | None = None, multiline: bool = False) -> DataFrame:
    """Weather observations from files with one response per line, or one per file with ``multiline``."""
    return parse_wu_payloads(spark.read.text(path, wholetext=multiline), station_id=station_id)


def pivot_measurements(df: DataFrame, mapping=None, missing_default: float | None = None) -> DataFrame:
    """Named measurements in the ``sensors`` array -> one column each, last non-null value wins.

    ``serial`` is the last one that is not empty.  A record's arrays are searched in place.
    """
    mapping = mapping or vocab.TSI_MEASUREMENTS
    all_of = F.flatten(F.transform("sensors", lambda s: F.coalesce(s["measurements"], F.array())))
    found = df.withColumn("found", F.filter(all_of, lambda m: m["data"]["value"].isNotNull()))

    def value(name: str) -> Column:
        v = F.try_element_at(F.filter("found", lambda m: m["name"] == name), F.lit(-1))["data"]["value"]
        return v if missing_default is None else F.coalesce(v, F.lit(float(missing_default)))

    serial = F.try_element_at(F.filter(F.transform("sensors", lambda s: s["serial"]), lambda s: s != ""), F.lit(-1))
    if missing_default is not None:
        serial = F.coalesce(serial, F.lit(""))
    return found.withColumns({"serial": serial, **{col: value(name) for name, col in mapping.items()}}).drop("found", "sensors")


def parse_tsi_records(df: DataFrame, device_id: str | None = None, missing_default: float | None = None) -> DataFrame:
    """Telemetry records -> wide rows; records without a time are dropped."""
    rows = df.filter(F.col("cloud_timestamp").isNotNull() & (F.col("cloud_timestamp") != ""))
    base = rows.select(
        F.try_to_timestamp("cloud_timestamp").alias("timestamp"), "cloud_account_id",
        (F.lit(device_id) if device_id else F.col("device_id")).alias("device_id"), "model",
        F.col("metadata.location.latitude").alias("latitude"), F.col("metadata.location.longitude").alias("longitude"),
        F.col("metadata.is_indoor").alias("is_indoor"), F.col("metadata.is_public").alias("is_public"), "sensors")
    return pivot_measurements(base, missing_default=missing_default)


def read_tsi_json(spark: SparkSession, path: str, device_id: str | None = None, missing_default: float | None = None,
                  multiline: bool = False) -> DataFrame:
    """Device telemetry from JSON lines, or from JSON arrays with ``multiline``."""
    records = spark.read.schema(vocab.TSI_TELEMETRY_SCHEMA).json(path, multiLine=multiline)
    return parse_tsi_records(records, device_id, missing_default)


def read_tsi_flat_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The older flat record form, under the same column names as the nested one."""
    # Flat mass-concentration and count names.
    names = {"mcpm1x0": "pm1_0", "mcpm2x5": "pm2_5", "mcpm4x0": "pm4_0", "mcpm10": "pm10", "mcpm2x5_aqi": "pm2_5_aqi",
             "mcpm10_aqi": "pm10_aqi", "ncpm0x5": "ncpm0_5", "ncpm1x0": "ncpm1_0", "ncpm2x5": "ncpm2_5",
             "ncpm4x0": "ncpm4_0", "ncpm10": "ncpm10", "rh": "rh", "temperature": "temperature", "tpsize": "tpsize",
             "co2_ppm": "co2_ppm", "co_ppm": "co_ppm", "baro_inhg": "baro_inhg", "o3_ppb": "o3_ppb", "no2_ppb": "no2_ppb",
             "so2_ppb": "so2_ppb", "ch2o_ppb": "ch2o_ppb", "voc_mgm3": "voc_mgm3"}
    schema = ("cloud_account_id string, cloud_device_id string, timestamp string, cloud_timestamp string, "
              "is_indoor boolean, is_public boolean, latitude double, longitude double, model string, serial string, "
              + ", ".join(f"{n} double" for n in names))
    df = spark.read.schema(schema).json(path, multiLine=multiline)
    return df.select(
        F.try_to_timestamp(F.coalesce("timestamp", "cloud_timestamp")).alias("timestamp"), "cloud_account_id",
        "cloud_device_id", "model", "serial", "latitude", "longitude", "is_indoor", "is_public",
        *[F.col(a).alias(b) for a, b in names.items()]).filter(F.col("timestamp").isNotNull())
