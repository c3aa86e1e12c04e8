"""Queries and operators that must do their whole job, and plans that must not gather a large side."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aeroloom.operators import quality, reports, rollups
from aeroloom.plans import views
from verification import catalog, checks_stream
from verification.feeds import Feeds
from verification.run import compare, duck


def test_latest_positions_ranks_every_sensor():
    """The query and its SQL take each sensor's own latest day; the rows of the one latest day are a query beside it."""
    assert "rank() OVER (PARTITION BY native_sensor_id" in catalog.ORACLES["a11_latest_positions"]
    assert "(SELECT max(day_ts) FROM enriched)" in catalog.ORACLES["a11_latest_day"]


def test_latest_positions_keeps_sensors_that_fell_silent(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [("a", "m", days[2], 1.0), ("a", "m", days[0], 2.0), ("silent", "m", days[1], 3.0)]
    df = spark.createDataFrame(rows, "native_sensor_id string, metric_name string, day_ts timestamp, avg_value double").withColumns(
        {"latitude": F.lit(1.0), "longitude": F.lit(2.0), "status": F.lit("active")})
    assert {(r[0], r["avg_value"]) for r in reports.latest_positions(df, per_sensor=True).collect()} == {("a", 1.0), ("silent", 3.0)}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_set_diff_counts_the_large_side_before_its_shuffle(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    b = spark.range(1000).select(F.when(F.col("id") > 0, F.lit("y")).alias("k"))
    assert [r["k"] for r in quality.set_diff(a, b).collect()] == ["x"]
    large = _plan(quality.set_diff(a, b)).split("LeftAnti")[1]
    assert "partial_count" in large


ROLLED = "day_ts timestamp, native_sensor_id string, metric_name string, samples bigint"


def _rolled(spark, rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1), *r) for r in rows], ROLLED)


@pytest.mark.parametrize("extra", [[], [(None, "pm10", 1)], [(None, "wind_speed_avg", 1)], [("p", "pm2_5", 1)],
                                   [("p", "pm2_5", 1), (None, "precip_total", 2)], [("p", "pm2_5", 0), (None, "precip_total", 2)]])
def test_source_lists_follow_in_and_not_in(spark, extra):
    rows = [("KNCDURHA1", "temperature", 0), ("w", "wind_speed_avg", 3), ("idle", "wind_speed_avg", 0), ("none", None, None), *extra]
    tsi = {k for k, m, n in rows if m in ("pm2_5", "pm10") and n}
    listed = {k for k, m, n in rows if m in ("wind_speed_avg", "precip_total") and n}
    weather = set() if None in tsi else {k for k in listed if k not in tsi and (k is not None or not tsi)}
    weather |= {k for k, _, _ in rows if k and k.startswith("KNCDURHA")}
    made = sorted(((r[0] or "", r[1]) for r in views.classify_sources(_rolled(spark, rows)).collect()))
    assert made == sorted([(k or "", "TSI") for k in tsi] + [(k or "", "WU") for k in weather])
    assert {r[0] for r in views.wu_sensor_list(_rolled(spark, rows)).collect()} == weather


def test_classification_reads_the_rollup_once_and_only_its_counts(spark):
    plan = _plan(catalog.QUERIES["c11_classify_sources"](spark, "/root/testdata/sf0.001"))
    assert "min_by" not in plan and "min(v" not in plan
    assert plan.count("FileScan") <= 6  # the printed plan names the scalar of NOT IN twice


def test_summary_of_both_kinds_aggregates_counts_alone(spark):
    plan = _plan(catalog.QUERIES["a22_source_summary"](spark, "/root/testdata/sf0.001"))
    assert "min_by" not in plan and plan.count("FileScan") <= 20


def test_all_enriched_has_a_sensor_of_both_kinds_twice(spark):
    rows = _rolled(spark, [("KNCDURHA1", "pm2_5", 1), ("d1", "pm10", 2), ("x", "humidity", 1)]).withColumns(
        {c: F.lit(1.0) for c in ("avg_value", "min_value", "max_value", "latitude", "longitude")})
    ids = spark.createDataFrame([], "native_sensor_id string, sensor_id string, effective_start_date date, effective_end_date date")
    current = spark.createDataFrame([], "native_sensor_id string, latitude double, longitude double, geog struct<longitude: double, latitude: double>, status string, effective_date date")
    got = sorted((r["native_sensor_id"], r["sensor_source"], r["sensor_category"]) for r in views.all_daily_enriched(rows, ids, current).collect())
    assert got == [("KNCDURHA1", "TSI", "Air Quality"), ("KNCDURHA1", "WU", "Weather"), ("d1", "TSI", "Air Quality")]


@pytest.mark.parametrize("name", ["c12_all_enriched", "a22_source_summary"])
def test_both_kinds_run_the_rollup_once(spark, name):
    """Beside the rows themselves only those without an id are aggregated, for the nulls of NOT IN."""
    plan = _plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))
    marks = [line for line in plan.splitlines() if "partial_bit_or" in line]
    assert marks and all("keys=[]" in line for line in marks)


@pytest.mark.parametrize("extra", [[], [(None, "pm10", 1)], [(None, "wind_speed_avg", 1)], [("p", "pm2_5", 0), (None, "precip_total", 2)],
                                   [("p", "pm2_5", 1), ("p", "wind_speed_avg", 1)], [(None, "pm10", 0), (None, None, None)]])
def test_all_enriched_follows_the_source_lists(spark, extra):
    rows = [("KNCDURHA1", "temperature", 0), ("KNCDURHA2", "temperature", 1), ("w", "wind_speed_avg", 3), ("w", "wind_speed_avg", 3), *extra]
    daily = _rolled(spark, rows).withColumns({c: F.lit(1.0) for c in ("avg_value", "min_value", "max_value", "latitude", "longitude")})
    ids = spark.createDataFrame([], "native_sensor_id string, sensor_id string, effective_start_date date, effective_end_date date")
    current = spark.createDataFrame([], "native_sensor_id string, latitude double, longitude double, geog struct<longitude: double, latitude: double>, status string, effective_date date")
    kinds = views.classify_sources(daily)
    expected = daily.filter("samples > 0").join(kinds, "native_sensor_id").select("native_sensor_id", "metric_name", "samples", "sensor_source")
    got = views.all_daily_enriched(daily, ids, current).select(expected.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_points_are_chosen_as_before_by_a_key_without_decimals(spark):
    """Earliest complete point; at one time the one with the least hash: the choice of the wider key."""
    base = dt.datetime(2024, 1, 1, 5)
    rows = [("a", base + dt.timedelta(microseconds=s), float(p), float(-p)) for p in range(40) for s in (3, 7)]
    rows += [("b", base, None, 1.0), ("b", base + dt.timedelta(minutes=59), 2.0, 3.0), ("c", base, 1.0, None)]
    long = spark.createDataFrame(rows, "native_sensor_id string, timestamp timestamp, latitude double, longitude double").withColumns(
        {"metric_name": F.lit("temperature"), "value": F.lit(1.0)})
    wide = long.select(F.col("timestamp").alias("ts"), "native_sensor_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("value").alias("temperature"))
    lat, lon = rollups.representative("latitude", "longitude", "timestamp")
    expected = sorted(tuple(r) for r in long.groupBy("native_sensor_id").agg(lat, lon).collect())
    for grain in ("hour", "day"):
        for made in (rollups.rollup(long, grain), rollups.rollup_wide(wide, "WU", grain)):
            assert sorted(tuple(r) for r in made.select("native_sensor_id", "latitude", "longitude").collect()) == expected
            assert "decimal" not in _plan(made)


def test_views_stand_on_written_tables(spark):
    plan = _plan(catalog.QUERIES["k16_register_views"](spark, "/root/testdata/sf0.001"))
    assert "/daily-" in plan and "/canonical-" in plan


@pytest.mark.parametrize("name", ["r02_stream_cooldown_unordered", "r03_stream_hourly_complete"])
def test_loads_of_several_files_stay_whole(spark, monkeypatch, name):
    """A load split over files is still one batch, so the loads come out of order as they did."""
    monkeypatch.setattr(checks_stream, "FILE_ROWS", 50)
    sf = "/root/testdata/sf0.01"
    loads = checks_stream._in_four(Feeds(spark, sf))
    assert loads.isStreaming
    assert compare(catalog.QUERIES[name](spark, sf).toPandas(), duck(sf).execute(catalog.ORACLES[name]).fetchdf()) == ""
