"""Table maintenance: repeated runs, empty days, merges."""

import datetime as dt

from pyspark.sql import functions as F

from aeroloom.plans import daily
from aeroloom.session import scratch_path
from aeroloom.sinks import tables as t

T0 = dt.datetime(2024, 1, 1)
KEYS = ["timestamp", "deployment_fk", "metric_name"]
STAR = "timestamp timestamp, deployment_fk string, metric_name string, value double"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_replace_window_over_more_than_one_bit_word(spark):
    path = scratch_path(spark, "w")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(150)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "dt date, v int")
    t.replace_window(df, path, days[0], days[-1])
    t.replace_window(df.filter("v % 7 = 0"), path, days[10], days[-1])
    kept = {r["v"] for r in spark.read.parquet(path).collect()}
    assert kept == set(range(10)) | {v for v in range(10, 150) if v % 7 == 0}


def test_replace_day_is_repeatable_and_clears(spark):
    path = scratch_path(spark, "d")
    df = spark.createDataFrame([("s", 1.0), ("t", 2.0)], "native_sensor_id string, v double")
    for _ in range(2):
        t.replace_day(df, path, "2024-01-02")
    t.replace_day(df.limit(1), path, "2024-01-03")
    assert spark.read.parquet(path).count() == 3
    t.replace_day(df.filter("false"), path, "2024-01-02")
    assert spark.read.parquet(path).count() == 1


def test_merge_policies_and_null_changes(spark):
    target = spark.createDataFrame([(T0, "a", "m", 1.0), (T0, "b", "m", None)], STAR)
    source = spark.createDataFrame([(T0, "a", "m", 2.0), (T0, "b", "m", 3.0), (T0, "c", "m", 4.0)], STAR)
    value = lambda df: {r["deployment_fk"]: r["value"] for r in df.collect()}
    assert value(t.upsert(target, source, KEYS)) == {"a": 2.0, "b": 3.0, "c": 4.0}
    assert value(t.upsert(target, source, KEYS, policy="keep")) == {"a": 1.0, "b": None, "c": 4.0}
    assert value(t.upsert(target, source, KEYS, only_if_changed=True)) == {"a": 2.0, "b": 3.0, "c": 4.0}
    assert value(t.upsert(target, source, KEYS, only_if_changed=True, parity=True)) == {"a": 2.0, "b": None, "c": 4.0}


def test_merge_touches_only_its_days(spark):
    path = scratch_path(spark, "m")
    first = spark.createDataFrame([(T0 + dt.timedelta(days=i), "a", "m", float(i)) for i in range(5)], STAR)
    t.merge_into(spark, path, first, KEYS)
    before = {f for f in spark.read.parquet(path).filter("dt <> date'2024-01-03'").inputFiles() if "2024-01-03" not in f}
    t.merge_into(spark, path, spark.createDataFrame([(T0 + dt.timedelta(days=2), "a", "m", 9.0)], STAR), KEYS)
    after = {f for f in spark.read.parquet(path).inputFiles() if "2024-01-03" not in f}
    assert before == after
    assert spark.read.parquet(path).filter("value = 9").count() == 1 and spark.read.parquet(path).count() == 5


def test_daily_run_is_repeatable(spark):
    root, warehouse = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    wu = spark.createDataFrame([(T0 + dt.timedelta(hours=6 * i), "KNCDURHA1", 36.0, -78.9, float(i)) for i in range(40)],
                               "timestamp timestamp, native_sensor_id string, lat double, lon double, temperature double")
    tsi = spark.createDataFrame([(T0 + dt.timedelta(hours=5 * i), "d1", 36.1, -78.8, float(i)) for i in range(40)],
                                "timestamp timestamp, native_sensor_id string, latitude double, longitude double, pm2_5 double")
    t.write_landing(wu, root, "WU")
    t.write_landing(tsi, root, "TSI")
    names = ("sensor_readings_long", "sensor_readings_hourly", "sensor_readings_daily", "sensor_canonical_location")
    read = lambda: {n: _rows(spark.read.parquet(f"{warehouse}/{n}")) for n in names}
    daily.backfill(spark, root, warehouse, "2024-01-01", "2024-01-08")
    once = read()
    daily.run(spark, warehouse, "2024-01-08")
    daily.run(spark, warehouse, "2024-01-08", rollup_from="raw")
    assert read() == once
    assert len(once["sensor_readings_long"]) == spark.read.parquet(root).filter("dt <= date'2024-01-08'").count()
    assert len(once["sensor_canonical_location"]) == 2


def test_insert_absent_keeps_existing(spark):
    target = spark.createDataFrame([(T0, "a", "m", 1.0)], STAR)
    source = spark.createDataFrame([(T0, "a", "m", 2.0), (T0, "b", "m", 3.0), (T0, "b", "m", 3.0)], STAR)
    assert [r["deployment_fk"] for r in t.insert_absent(target, source, KEYS).collect()] == ["b"] and F


def _staged(spark, rows, path, source, seq=None):
    t.write_staging(spark.createDataFrame(rows, STAR + ", n bigint"), path, source, seq=seq)


def test_the_last_load_wins_whatever_its_value_or_file_time(spark):
    staging, moved, target = (scratch_path(spark, n) for n in ("staging", "moved", "star"))
    _staged(spark, [(T0, "d", "m", 50.0, 1), (T0, "e", "m", 5.0, 2), (T0, "e", "m", 9.0, 1)], staging, "wu", "n")
    _staged(spark, [(T0, "d", "m", 3.0, 1)], staging, "tsi")
    # A copy written later and in another order does not change the winner.
    for source in ("tsi", "wu"):
        spark.read.parquet(staging).filter(F.col("source") == source).write.mode("append").partitionBy("source", "dt").parquet(moved)
    for place in (staging, moved):
        daily.merge_range(spark, target, place, "2024-01-01", "2024-01-01")
        assert _rows(spark.read.parquet(target).select(*KEYS, "value")) == [(T0, "d", "m", 3.0), (T0, "e", "m", 5.0)]
    assert t.next_load(spark, staging) == 3 and t.next_load(spark, staging) == 4


def test_a_merge_runs_its_source_once(spark):
    path = scratch_path(spark, "star")
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(T0, "d", "m", 1.0), (T0 + dt.timedelta(days=1), "d", "m", 2.0)], STAR).coalesce(1)
    t.merge_into(spark, path, rows, KEYS)
    for merge in (t.merge_into, t.append_absent):
        before = runs.value
        merge(spark, path, rows.mapInPandas(counted, rows.schema), KEYS)
        assert runs.value - before == 2


def test_current_alerts_by_id(spark):
    path = scratch_path(spark, "current")
    schema = "id string, timestamp timestamp, level string"
    t.write_current(spark.createDataFrame([("a", T0, "high"), ("b", T0, "low"), ("a", T0 + dt.timedelta(hours=1), "low")], schema), path)
    t.write_current(spark.createDataFrame([("b", T0 - dt.timedelta(days=1), "medium"), ("c", T0, "high")], schema), path)
    assert {r["id"]: r["level"] for r in spark.read.schema(schema).json(path).collect()} == {"a": "low", "b": "medium", "c": "high"}


def test_headers_take_the_first_bytes_of_a_file(spark):
    from aeroloom.sources import history

    folder = scratch_path(spark, "csv")
    spark.range(60_000).selectExpr("id AS a", "id * 2 AS `b c`").coalesce(1).write.option("header", True).csv(folder)
    files = history._list_csv(spark, folder)
    heads = history._heads(spark, files)
    assert [(r["path"], r["head"]) for r in heads] == [(files[0], "a,b c")]
    assert history.read_csv_union(spark, files).count() == 60_000


def test_landing_sorts_set_cells_alone_and_writes_every_column(spark, monkeypatch, tmp_path):
    """Columns of a wide row are mostly null: they go through shuffle and sort as one list, and come out as they were."""
    names = [f"c{i}" for i in range(30)]
    values = [None, float("nan"), -0.0, float("inf"), 1.5]
    rows = [(f"2024-01-0{1 + n % 3} 00:00:00", f"s{n % 4}", n, *[values[(n * 7 + i * 3) % 5] if (n + i) % 4 else None for i in range(30)]) for n in range(40)]
    rows.append(("2024-01-01 00:00:00", "empty", 40, *[None] * 30))
    df = spark.createDataFrame(rows, "timestamp string, native_sensor_id string, n int, " + ", ".join(f"{c} double" for c in names))
    laid = []
    layout = t.layout
    monkeypatch.setattr(t, "layout", lambda rows, *a: laid.append(rows) or layout(rows, *a))
    t.write_landing(df, str(tmp_path), "TSI")
    assert len(laid[0].columns) < 10
    back = spark.read.parquet(str(tmp_path))
    assert [c for c in back.columns if c in df.columns] == df.columns
    assert {r["n"]: repr(tuple(r[c] for c in names)) for r in back.collect()} == {r[2]: repr(tuple(r[3:])) for r in rows}
