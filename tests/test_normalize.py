"""Normalisation, payload and filter edge cases on tiny frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from aeroloom import vocab
from aeroloom.functions import air, times
from aeroloom.functions.numbers import exact_round, fixed, numeric, round_double
from aeroloom.operators import filters, joins, normalize as n, quality, rollups
from aeroloom.session import scratch_path
from aeroloom.sources import catalogs, history, landing, payloads

T0 = dt.datetime(2024, 1, 1)


def test_standardize_keeps_first_of_duplicates(spark):
    df = spark.createDataFrame([("a", "b", 1.0)], "cloud_device_id string, device_id string, rh double")
    assert n.standardize(df, "TSI").collect() == [("a", 1.0)]


def test_unpivot_rows_equal_non_null_cells(spark):
    rows = [(T0, "s", 1.0, None, 3.0), (T0, "t", None, None, None)]
    df = spark.createDataFrame(rows, "ts timestamp, native_sensor_id string, temperature double, humidity double, uv_high double")
    long = n.unpivot_metrics(df, ["ts", "native_sensor_id"], vocab.WU_METRICS)
    assert {(r["metric_name"], r["value"]) for r in long.collect()} == {("temperature", 1.0), ("uv_high", 3.0)}


def test_unpivot_of_an_id_that_is_also_a_metric(spark):
    df = spark.createDataFrame([("s", 36.0, 5.0)], "native_sensor_id string, latitude double, pm2_5 double")
    out = n.unpivot_metrics(df, ["native_sensor_id", "latitude"], ["latitude", "pm2_5"])
    assert {(r["latitude"], r["metric_name"], r["value"]) for r in out.collect()} == {(36.0, "latitude", 36.0), (36.0, "pm2_5", 5.0)}


def test_unpivot_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "wide")
    spark.createDataFrame([(T0, "s", 1.0, 2.0)], "ts timestamp, native_sensor_id string, temperature double, humidity double").write.parquet(path)
    df = n.unpivot_metrics(spark.read.parquet(path), ["ts", "native_sensor_id"], vocab.WU_METRICS, ["humidity"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "humidity" in plan and "temperature" not in plan


def test_numeric_text(spark):
    values = ["1", " 2.5 ", "-3e2", ".5", "1d", "abc", "", None, "NaN"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(numeric(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [1.0, 2.5, -300.0, 0.5, None, None, None, None, None]


def test_exact_rounding_is_half_even_on_binary(spark):
    values = [0.25, 0.35, 0.45, 2.5, 1234567.05, -0.04, 35.449999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(exact_round(F.col("v"), 1).alias("r"), fixed(F.col("v"), 1).alias("t")).collect()
    assert [r["r"] for r in got] == [round(v, 1) for v in values]
    assert [r["t"] for r in got] == [f"{v:.1f}" for v in values]


@pytest.mark.parametrize("value,parity,default", [(12.0, 50, 50), (12.05, 500, 50), (12.1, 51, 51), (35.45, 500, 100), (500.4, 500, 500), (600.0, 500, 500), (-1.0, 500, 0)])
def test_aqi_gaps(spark, value, parity, default):
    row = spark.createDataFrame([(value,)], "v double").select(air.aqi(F.col("v"), True).alias("p"), air.aqi(F.col("v")).alias("d")).first()
    assert (row["p"], row["d"]) == (parity, default)


@pytest.mark.parametrize("rule,value,expect", [
    ("materialize", 10**11, "1973-03-03 09:46:40"), ("materialize", 10**11 - 1, "5138-11-16 09:46:39"),
    ("normalize_day", 10**12, "2001-09-09 01:46:40"), ("staging", 1704067200, "2024-01-01 00:00:00"),
    ("staging", 1704067200 * 10**6, "2024-01-01 00:00:00"), ("materialize", 1704067200 * 10**9 + 999, "2024-01-01 00:00:00")])
def test_epoch_units(spark, rule, value, expect):
    out = spark.createDataFrame([(value,)], "epoch bigint").select(times.epoch_to_timestamp(F.col("epoch"), rule).cast("string")).first()[0]
    assert out == expect


def test_conform_modes(spark):
    df = spark.createDataFrame([("1", "x", 9)], "a string, b string, extra int")
    out = n.conform(df, "a double, b double, c string")
    assert out.columns == ["a", "b", "c"] and out.first() == (1.0, None, None)
    kept = n.conform(df, "a double, b double", "keep")
    assert dict(kept.dtypes) == {"a": "double", "b": "string"}


def test_not_in_follows_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    pick = lambda rows: sorted(str(r["k"]) for r in filters.in_set(df, spark.createDataFrame(rows, "k string"), "k", negate=True).collect())
    assert pick([("a",)]) == ["b"]
    assert pick([("a",), (None,)]) == []
    assert pick([]) == ["None", "a", "b"]


def test_latest_mapping_resumes_after_a_short_one(spark):
    d = dt.date
    id_map = spark.createDataFrame([("A", "n", None, None), ("B", "n", d(2024, 1, 10), d(2024, 1, 12))],
                                   "sensor_id string, native_sensor_id string, effective_start_date date, effective_end_date date")
    days = spark.createDataFrame([("n", d(2024, 1, i)) for i in (9, 10, 12, 13)] + [("other", d(2024, 1, 9))], "native_sensor_id string, day date")
    got = {(r["native_sensor_id"], r["day"].day): r["sensor_id"] for r in joins.map_sensor_id(days, id_map, "day", "latest").collect()}
    assert got == {("n", 9): "A", ("n", 10): "B", ("n", 12): "B", ("n", 13): "A", ("other", 9): "other"}
    assert [r["native_sensor_id"] for r in joins.overlapping_mappings(id_map).collect()] == ["n"]


def test_resample_keeps_empty_bins_between_first_and_last(spark):
    rows = [("s", T0, 1.0), ("s", T0 + dt.timedelta(minutes=30), 3.0), ("s", T0 + dt.timedelta(hours=3), 5.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    got = rollups.resample_mean(df, "k", "ts", "h").orderBy("ts").collect()
    assert [r["v"] for r in got] == [2.0, None, None, 5.0]


def test_wide_and_long_rollups_agree(spark):
    rows = [(T0 + dt.timedelta(minutes=17 * i), f"s{i % 2}", 36.0 + i * 0.1 if i % 3 else None, -78.0, float(i) if i % 4 else None, float(i * 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp, native_sensor_id string, lat double, lon double, temperature double, humidity double")
    for grain in ("hour", "day"):
        a = rollups.rollup(n.source_long(df, "WU"), grain).drop("geog")
        b = rollups.rollup_wide(df, "WU", grain).drop("geog")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    hourly, daily = rollups.rollup_wide(df, "WU", "hour"), rollups.rollup_wide(df, "WU", "day")
    assert hourly.agg(F.sum("samples")).first() == daily.agg(F.sum("samples")).first()


def test_metric_units_win_by_presence(spark):
    obs = {"stationID": "S", "obsTimeUtc": "2024-01-01T12:00:00Z", "tempAvg": 1, "humidityAvg": 60, "uvHigh": 3,
           "imperial": {"tempAvg": 2, "windspeedAvg": 7}, "metric": {"tempAvg": None}}
    df = spark.createDataFrame([(json.dumps({"observations": [obs]}),)], "value string")
    row = payloads.parse_wu_payloads(df).first()
    assert (row["stationID"], row["tempAvg"], row["windspeedAvg"], row["humidityAvg"], row["uvHigh"]) == ("S", None, 7.0, 60.0, 3.0)
    assert row["obsTimeUtc"] == dt.datetime(2024, 1, 1, 12)


def test_telemetry_array_file_and_empty_sensors(spark, tmp_path):
    records = [{"cloud_timestamp": "2024-01-01T00:00:00Z", "device_id": "d", "sensors": []}, {"device_id": "lost"},
               {"cloud_timestamp": "2024-01-01T01:00:00Z", "device_id": "d", "sensors": [
                   {"serial": "x", "measurements": [{"name": "CO2", "data": {"value": 400}}, {"name": "CO2", "data": {"value": None}}]}]}]
    (tmp_path / "t.json").write_text(json.dumps(records))
    rows = payloads.read_tsi_json(spark, str(tmp_path), multiline=True).orderBy("timestamp").collect()
    assert [(r["co2_ppm"], r["serial"]) for r in rows] == [(None, None), (400.0, "x")]
    zero = payloads.read_tsi_json(spark, str(tmp_path), missing_default=0.0, multiline=True).orderBy("timestamp").first()
    assert (zero["co2_ppm"], zero["serial"]) == (0.0, "")


def test_history_prefers_master_files(spark, tmp_path):
    for rel, text in {"master_data/wu_master_historical_data.csv": "timestamp,tempAvg\n2024-01-01,5\n", "master_data/other.csv": "x\n1\n",
                      "raw_pulls/tsi/2024/a.csv": "cloud_timestamp,PM 2.5\n2024-01-01,7\n"}.items():
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    every = history.read_history_csv(spark, str(tmp_path)).collect()
    assert sorted((r["place"], r["source_file"]) for r in every) == [
        ("master_data", "other.csv"), ("master_data", "wu_master_historical_data.csv"), ("raw_pulls", "a.csv")]
    rows = history.read_history_csv(spark, str(tmp_path), first_only=True).collect()
    assert [(r["tempAvg"], r["source_file"]) for r in rows] == [("5", "wu_master_historical_data.csv")]


def test_catalog_object_form(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"wu": [{"name": "MS", "stationId": "K1", "lat": "36.1"}, {"id": "K2", "start_date": "2024/01/05"}],
                                                 "tsi": [{"id": "d1"}]}))
    rows = {r["native_sensor_id"]: r for r in catalogs.sensor_catalog(spark, str(tmp_path / "c.json")).collect()}
    assert rows["K1"]["friendly_name"] == "MS" and rows["K1"]["latitude"] == 36.1
    assert rows["K2"]["start_date"] == dt.date(2024, 1, 5) and rows["d1"]["sensor_type"] == "TSI"


def test_landing_scan_without_a_tree_is_empty(spark):
    assert landing.scan_landing(spark, scratch_path(spark, "none"), "WU").count() == 0


def test_threshold_precedence():
    assert quality.row_thresholds({"a": 1, "b": 1, "c": 1}, {"b": 2, "c": 2}, {"c": 3}) == {"a": 1, "b": 2, "c": 3}


def test_test_sensors_are_split(spark):
    df = spark.createDataFrame([("TEST-1",), ("BS-2",), (None,)], "native_sensor_id string")
    test, production = filters.split_test(df)
    assert (test.count(), production.count()) == (1, 2)


def test_rounding_of_values_that_are_not_finite(spark):
    df = spark.createDataFrame([(0.25,), (float("inf"),), (float("-inf"),), (float("nan"),), (None,)], "v double")
    got = [r[0] for r in df.select(exact_round(F.col("v"), 1)).collect()]
    assert got[0] == 0.2 and got[1] == float("inf") and got[2] == float("-inf") and got[3] != got[3] and got[4] is None


def test_profile_covers_every_numeric_column(spark):
    df = spark.range(3).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(60)])
    rows = {r["column_name"]: r for r in rollups.profile(df).collect()}
    assert len(rows) == 60 and all(rows[f"c{i}"]["max_value"] == i + 2 for i in range(60))


def test_a_response_is_parsed_once_and_its_odd_observations_stay(spark):
    """One step parses a response; a list with something else than objects still gives a row per element."""
    good = '{"stationID":"a","tempAvg":1,"qcStatus":1,"metric":{"tempAvg":2.5},"imperial":{"tempAvg":9,"qcStatus":null}}'
    odd = {"null": (None, None, None), "5": (None, None, None), '"x"': (None, None, None), "[1]": (None, None, None),
           '{"stationID":"b","imperial":5,"tempAvg":7}': ("b", 7.0, None), '{"metric":[1],"stationID":"c","tempAvg":"7"}': ("c", 7.0, None),
           '{"stationID":"n","metric":{"tempAvg":null},"tempAvg":3}': ("n", None, None)}
    rows = [(i, '{"observations":[' + f"{good},{text},{good}" + "]}") for i, text in enumerate(odd)] + [(98, "junk"), (99, '{"observations":null}'), (97, None)]
    made = payloads.parse_wu_payloads(spark.createDataFrame(rows, "i int, value string"), fields={"stationID": "string", "tempAvg": "double", "qcStatus": "bigint"})
    assert sorted(map(repr, (tuple(r) for r in made.collect()))) == sorted(
        map(repr, (r for i, want in enumerate(odd.values()) for r in ((i, "a", 2.5, None), (i, *want), (i, "a", 2.5, None)))))
    steps = [line for line in made._jdf.queryExecution().executedPlan().toString().splitlines() if "from_json" in line]
    assert len(steps) == 1


def test_numbers_that_json_does_not_know_are_read(spark):
    text = '{"observations":[{"metric":{"tempAvg":-Infinity},"tempHigh":Infinity}]}'
    made = payloads.parse_wu_payloads(spark.createDataFrame([(text,)], "value string"), fields={"tempAvg": "double", "tempHigh": "double"})
    assert tuple(made.first()) == (float("-inf"), float("inf"))


def test_round_double_is_the_round_of_spark(spark):
    """Ties, values next to them, large ones, signs of zero and what is no number."""
    near = [k / 1e5 + half + d for k in (-12345678, -3, 0, 7, 9999999) for half in (0.0, 5e-6, -5e-6) for d in (0.0, 1e-13, -1e-13, 1e-9)]
    values = [*near, 0.0, -0.0, -1e-9, 1e-5, 36.005, 1e300, -1e10, 123456789.123456789, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 2, 5):
        both = df.select(F.round("x", digits).cast("string").alias("a"), round_double(F.col("x"), digits).cast("string").alias("b"))
        assert [r for r in both.collect() if r.a != r.b] == []
