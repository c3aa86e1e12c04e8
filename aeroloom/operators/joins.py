"""Joins of readings with identity, location and deployment dimensions.

No join here forces a broadcast: Spark broadcasts a side only when its measured size is under the session's
limit, and otherwise shuffles, splitting skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from aeroloom.functions.times import as_date


def attach_deployment(df: DataFrame, deployments: DataFrame, sensor_type: str) -> DataFrame:
    """Readings of sensors with a deployment of the type; a sensor with two deployments gives two rows."""
    active = (deployments.filter(F.col("sensor_type") == sensor_type)
              .select("native_sensor_id", F.col("deployment_pk").alias("deployment_fk")))
    return df.join(active, "native_sensor_id")


def keep_sensors(df: DataFrame, sensor_list: DataFrame) -> DataFrame:
    return df.join(sensor_list.select("native_sensor_id"), "native_sensor_id", "left_semi")


def left_attach(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim, key, "left")


def validity(day: Column, start: Column, end: Column) -> Column:
    """``day`` within an inclusive range whose null ends are open."""
    return (start.isNull() | (day >= start)) & (end.isNull() | (day <= end))


def map_sensor_id(df: DataFrame, id_map: DataFrame, date_col: str, on_overlap: str = "fan_out") -> DataFrame:
    """Add ``sensor_id`` valid on the reading's day, the native id where no mapping is.

    Overlapping mappings give one row each; ``on_overlap='latest'`` lets the latest start win.
    """
    if on_overlap == "latest":
        id_map = disjoint_mappings(id_map)
    m = id_map.select(F.col("native_sensor_id").alias("map_native"), F.col("sensor_id").alias("map_sensor"),
                      "effective_start_date", "effective_end_date")
    day = F.to_date(df[date_col])
    joined = df.join(m, (df["native_sensor_id"] == m["map_native"])
                     & validity(day, m["effective_start_date"], m["effective_end_date"]), "left")
    return joined.select(*[df[c] for c in df.columns],
                         F.coalesce("map_sensor", df["native_sensor_id"]).alias("sensor_id"))


def overlapping_mappings(id_map: DataFrame) -> DataFrame:
    """Native ids with mappings that are valid on a common day, with the first such day.

    One pass in start order: a mapping overlaps when it starts by the latest end seen before it.
    """
    far = F.lit("9999-12-31").cast("date")
    start = F.coalesce("effective_start_date", F.lit("0001-01-01").cast("date"))
    w = Window.partitionBy("native_sensor_id").orderBy(start, F.coalesce("effective_end_date", far), "sensor_id")
    seen = id_map.withColumn("prev_end", F.max(F.coalesce("effective_end_date", far))
                             .over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return (seen.filter(start <= F.col("prev_end")).groupBy("native_sensor_id")
            .agg(F.min(start).alias("first_overlap"), F.count(F.lit(1)).alias("overlaps")))


def disjoint_mappings(id_map: DataFrame) -> DataFrame:
    """Cut mappings into ranges that do not overlap, the latest start winning on every day."""
    low, far = F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")
    m = id_map.select("native_sensor_id", "sensor_id", F.coalesce("effective_start_date", low).alias("s"),
                      F.coalesce("effective_end_date", far).alias("e"))
    edges = (m.select("native_sensor_id", F.explode(F.array(
        F.col("s"), F.when(F.col("e") < far, F.date_add("e", 1)))).alias("edge"))
        .filter(F.col("edge").isNotNull()).distinct())
    w = Window.partitionBy("native_sensor_id").orderBy("edge")
    spans = edges.select("native_sensor_id", F.col("edge").alias("from"),
                         F.coalesce(F.date_sub(F.lead("edge").over(w), 1), far).alias("to"))
    picked = (spans.join(m, "native_sensor_id").filter(F.col("from").between(F.col("s"), F.col("e")))
              .groupBy("native_sensor_id", "from", "to")
              .agg(F.max_by("sensor_id", F.struct("s", "sensor_id")).alias("sensor_id")))
    return picked.select("sensor_id", "native_sensor_id",
                         F.when(F.col("from") > low, F.col("from")).alias("effective_start_date"),
                         F.when(F.col("to") < far, F.col("to")).alias("effective_end_date"))


def missing_from(candidates: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return candidates.join(dim.select(key), key, "left_anti")


def align_counts(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Full outer join of two count tables, absent counts as zero."""
    counts = [c for c in (*a.columns, *b.columns) if c != on]
    return a.join(b, on, "full").select(on, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def date_spine(sensors: DataFrame, start, end, name: str = "date") -> DataFrame:
    """Every sensor with every day of the range; the days are generated per sensor, without a cross join."""
    days = F.sequence(F.lit(as_date(start)), F.lit(as_date(end)))
    return sensors.select("*", F.explode(days).alias(name))


def missing_dates(readings: DataFrame, sensors: DataFrame, start, end, metric: str, ts: str = "day_ts") -> DataFrame:
    """(sensor, day) pairs of the range without a reading of ``metric``."""
    seen = (readings.filter(F.col("metric_name") == metric)
            .select("native_sensor_id", F.to_date(ts).alias("date")).distinct())
    spine = date_spine(sensors.select("native_sensor_id").distinct(), start, end)
    return (spine.join(seen, ["native_sensor_id", "date"], "left_anti")
            .withColumn("data_status", F.lit("MISSING")))


def join_periods(cur: DataFrame, prev: DataFrame, keys) -> DataFrame:
    return cur.join(prev, list(keys), "left")


def latest_readings(readings: DataFrame, deployments: DataFrame, sensors: DataFrame, since) -> DataFrame:
    """Star lookup of the readings since a time, latest first."""
    recent = readings.filter(F.col("timestamp") >= F.lit(str(since)).cast(readings.schema["timestamp"].dataType))
    return (recent.join(deployments.select("deployment_pk", "sensor_fk", "location"),
                        recent["deployment_fk"] == F.col("deployment_pk"))
            .join(sensors.select("sensor_pk", "friendly_name"), F.col("sensor_fk") == F.col("sensor_pk"))
            .select("friendly_name", "location", "timestamp", "metric_name", "value")
            .orderBy(F.desc("timestamp")))


def active_deployments(deployments: DataFrame, sensors: DataFrame) -> DataFrame:
    return (deployments.filter(F.col("end_date").isNull())
            .join(sensors, deployments["sensor_fk"] == sensors["sensor_pk"])
            .select("deployment_pk", "native_sensor_id", "sensor_type"))


def with_bounds(df: DataFrame, d) -> DataFrame:
    """Day bounds in epoch seconds and milliseconds as literal columns."""
    first = (as_date(d) - as_date("1970-01-01")).days * 86400
    big = lambda n: F.lit(n).cast("bigint")
    return df.withColumns({"sec_from": big(first), "sec_to": big(first + 86399),
                           "ms_from": big(first * 1000), "ms_to": big(first * 1000 + 86399999)})
