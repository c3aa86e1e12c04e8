"""Rollups, resampling and their plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aeroloom.operators import rollups
from aeroloom.streaming import streams
from verification.catalog import QUERIES

SF = "/root/testdata/sf0.001"
BASE = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("name", ["a01_hourly_rollup", "a01_hourly_from_wide", "a02_daily_rollup", "a02_daily_from_wide", "a05_representative", "a17_pm25_daily"])
def test_rollups_are_hash_aggregates(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_stream_rollup_is_a_hash_aggregate(spark):
    rows = spark.createDataFrame([], "timestamp timestamp, native_sensor_id string, metric_name string, value double, latitude double, longitude double")
    plan = streams.stream_hourly(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_one_point_and_a_fixed_choice_among_ties(spark):
    """Latitude and longitude come from one row, the earliest complete one; rows of one time give one choice in any order."""
    rows = [("s", BASE - dt.timedelta(days=20000), None, 1.0), ("s", BASE, 5.0, 50.0), ("s", BASE, 6.0, 60.0), ("s", BASE, 7.0, 70.0), ("s", BASE + dt.timedelta(hours=1), 1.0, 1.0),
            ("old", dt.datetime(1905, 1, 1), 2.0, 3.0), ("old", BASE, 4.0, 5.0), ("none", BASE, None, 5.0)]
    seen = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        lat, lon = rollups.representative("lat", "lon", "ts")
        got = {r["k"]: (r["latitude"], r["longitude"]) for r in spark.createDataFrame(order, "k string, ts timestamp, lat double, lon double").groupBy("k").agg(lat, lon).collect()}
        assert got["s"][1] == 10 * got["s"][0] and got["s"][0] >= 5 and got["old"] == (2.0, 3.0) and got["none"] == (None, None)
        seen.add(got["s"])
    assert len(seen) == 1


def test_one_stray_time_does_not_make_one_long_array(spark):
    """A reading of 1970 among second bins of 2024: 1.7 billion bins, none of them held in one array."""
    df = spark.createDataFrame([("s", dt.datetime(1970, 1, 1), 1.0), ("s", BASE, 2.0), ("t", BASE, 3.0)], "k string, ts timestamp, v double")
    out = rollups.resample_mean(df, "k", "ts", "s")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert f"{rollups.STRETCH}" in plan
    hours = rollups.resample_mean(df, "k", "ts", "h")
    n = (BASE - dt.datetime(1970, 1, 1)) // dt.timedelta(hours=1) + 2
    assert hours.count() == n and hours.filter("v IS NOT NULL").count() == 3
    ends = hours.groupBy("k").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count_distinct("ts").alias("n")).orderBy("k").collect()
    assert [(r["k"], r["a"], r["b"], r["n"]) for r in ends] == [("s", dt.datetime(1970, 1, 1), BASE, n - 1), ("t", BASE, BASE, 1)]


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_row_id_rollup_keeps_no_map_of_groups_before_the_shuffle(spark, grain):
    """Rows are dealt by hour or day, sensor and metric and aggregated once there; one exchange in all."""
    base = dt.datetime(2024, 1, 1, 5)
    rows = [(base + dt.timedelta(minutes=m), "a", "m", float(m)) for m in (0, 30, 59, 60)] + [(base, None, "m", 1.0), (None, "a", "m", 9.0), (base, "a", "n", None)]
    long = spark.createDataFrame(rows, "timestamp timestamp, native_sensor_id string, metric_name string, value double").withColumns(
        {c: F.lit(1.0) for c in ("latitude", "longitude")})
    made = rollups.rollup_with_row_id(long, grain, "sha2")
    got = {(str(r[f"{grain}_ts"]), r["native_sensor_id"], r["metric_name"]): (r["avg_value"], r["min_value"], r["max_value"], r["samples"]) for r in made.collect()}
    want = {(t, None, "m"): (1.0, 1.0, 1.0, 1) for t in [str(base if grain == "hour" else base.replace(hour=0))]}
    first = next(iter(want))[0]
    want |= {(first, "a", "n"): (None, None, None, 1), ("None", "a", "m"): (9.0, 9.0, 9.0, 1)}
    want |= ({(first, "a", "m"): (89 / 3, 0.0, 59.0, 3), (str(base.replace(hour=6)), "a", "m"): (60.0, 60.0, 60.0, 1)} if grain == "hour"
             else {(first, "a", "m"): (149 / 4, 0.0, 60.0, 4)})
    assert got == want
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan.split("Exchange")[1]


def test_backfill_keeps_no_map_of_hours_before_the_shuffle(spark, monkeypatch):
    """The hourly rollup of a run deals its rows by group and has the rows of the plain one; that of days still combines map-side."""
    from aeroloom.plans import daily
    from aeroloom.session import scratch_path

    rows = [(BASE + dt.timedelta(minutes=m), k, float(m), None if m == 60 else 36.0 + m, -78.0) for m in (0, 30, 59, 60, 1500) for k in ("a", None)]
    raw = spark.createDataFrame(rows, "timestamp timestamp, native_sensor_id string, temperature double, lat double, lon double")
    landing, warehouse = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    daily.tables.write_landing(raw, landing, "WU")
    plans, plain = {}, rollups.rollup
    monkeypatch.setattr(daily.rollups, "rollup", lambda df, grain, *a, **k: plans.setdefault(grain, plain(df, grain, *a, **k)))
    daily.backfill(spark, landing, warehouse, "2024-01-01", "2024-01-02", ["WU"])
    below = {g: made._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1] for g, made in plans.items()}
    assert "Aggregate" not in below["hour"] and "Aggregate" in below["day"]
    made = spark.read.schema(daily.HOURLY_SCHEMA).parquet(f"{warehouse}/sensor_readings_hourly").drop("dt")
    long = spark.read.schema(daily.LONG_SCHEMA).parquet(f"{warehouse}/sensor_readings_long").drop("dt")
    assert made.count() == 6 and sorted(map(str, made.collect())) == sorted(map(str, plain(long, "hour").collect()))


def _odd_long(spark):
    """Known and unknown names of metrics, none at all, readings without sensor, value or point, several of one hour and of the next day."""
    rows = [(BASE + dt.timedelta(minutes=m), k, n, None if m == 59 else float(m), None if m == 60 else 36.0 + m, -78.0)
            for m in (0, 30, 59, 60, 1500) for k in ("a", "b", None) for n in ("pm2_5", "humidity", "other", None)]
    return spark.createDataFrame(rows, "timestamp timestamp, native_sensor_id string, metric_name string, value double, latitude double, longitude double")


def _texts(df, *cols):
    return sorted(str(r) for r in (df.select(*cols) if cols else df).collect())


def test_numbered_metrics_come_back(spark):
    from aeroloom.operators import normalize

    long = _odd_long(spark)
    light = normalize.numbered(long)
    assert light.columns[-3:] == [normalize.NAME_PARTS[0], "value", normalize.NAME_PARTS[1]] and "metric_name" not in light.columns
    assert {r[0] for r in light.select(normalize.NAME_PARTS[0]).collect()} == {"other", None}
    assert _texts(normalize.named(light), *long.columns) == _texts(long)


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_dealt_rollup_sends_light_rows_and_holds_no_groups(spark, grain):
    """The rows of the plain rollup from one exchange of rows without names, hours and points, and aggregates over sorted rows."""
    long = _odd_long(spark)
    made, plain = rollups.rollup(long, grain, dealt=True), rollups.rollup(long, grain)
    assert _texts(made, *plain.columns) == _texts(plain)
    assert made.filter(~F.col("dt").eqNullSafe(F.to_date(f"{grain}_ts"))).count() == 0
    plan = rollups.rollup(long, grain, dealt=True)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange")
    assert "rangepartitioning" in below and "HashAggregate" not in plan and above.count("SortAggregate") == 2 and above.count("Sort [") == 1
    assert f"AS {grain}_ts" not in below and "geog" not in below and "AS first" not in below


def test_hours_of_a_run_are_shuffled_once_and_no_shuffle_stays(spark, monkeypatch):
    """The hourly table is written as it was aggregated, in order of sensor and metric within each day, and the files of all shuffles go
    with the write that made them."""
    import time

    from aeroloom.plans import daily
    from aeroloom.session import scratch_path

    def shuffles():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    rows = [(BASE + dt.timedelta(minutes=m), k, float(m), 1.0, 36.0, -78.0) for m in range(0, 2800, 7) for k in ("b", "a")]
    raw = spark.createDataFrame(rows, "timestamp timestamp, native_sensor_id string, temperature double, humidity double, lat double, lon double")
    landing, warehouse = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    laid, layout, before, key = [], daily.tables.layout, shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    monkeypatch.setattr(daily.tables, "layout", lambda df, *a: laid.append(df.columns) or layout(df, *a))
    had = spark.conf.get(key)
    daily.tables.write_landing(raw, landing, "WU")
    daily.backfill(spark, landing, warehouse, "2024-01-01", "2024-01-02", ["WU"])
    assert spark.conf.get(key) == had
    assert any("day_ts" in c for c in laid) and not any("hour_ts" in c or "geog" in c or "metric_name" in c for c in laid)
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before
    hourly = spark.read.schema(daily.HOURLY_SCHEMA).parquet(f"{warehouse}/sensor_readings_hourly")
    order = [(r["file"], r["native_sensor_id"], r["metric_name"], r["hour_ts"]) for r in hourly.select("*", F.input_file_name().alias("file")).collect()]
    assert len(order) == 47 * 4 and all(a < b for a, b in zip(order, order[1:], strict=False) if a[0] == b[0])
    assert hourly.filter("geog.latitude = latitude AND geog.longitude = longitude").count() == 47 * 4


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_row_id_rollup_sends_numbers_of_metrics_to_a_given_number_of_tasks(spark, grain):
    """Rows of one hour and sensor stay side by side, their metrics as numbers; Spark does not join tasks by their bytes."""
    from aeroloom.operators import normalize

    long, out = _odd_long(spark), f"{grain}_ts"
    made, plain = rollups.rollup_with_row_id(long, grain), rollups.rollup(long, grain)
    cols = [out, "native_sensor_id", "metric_name", "avg_value", "min_value", "max_value", "samples"]
    assert _texts(made, *cols) == _texts(plain, *cols)
    exchange = next(x for x in made._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    assert "REPARTITION_BY_NUM" in exchange and f", {parts})" in exchange
    assert ("metric number" in exchange) == (grain == "day") and "metric_name" not in exchange
    assert normalize.NAME_PARTS[1] in made._jdf.queryExecution().optimizedPlan().toString()
