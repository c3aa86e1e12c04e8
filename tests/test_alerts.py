"""Alerts and the time-split cooldown against a plain fold."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroloom.operators import alerts as al
from aeroloom.session import scratch_path
from aeroloom.streaming import streams

BASE = dt.datetime(2024, 1, 1)


def fold(rows, minutes, state=None):
    """Keep an alert unless a kept one of its key is under ``minutes`` old."""
    last, kept = dict(state or {}), []
    for key, at, id_ in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or at - last[key] >= dt.timedelta(minutes=minutes):
            last[key] = at
            kept.append(id_)
    return sorted(kept)


def make(seed, n, step_seconds, keys=("a", "b", None)):
    rng = random.Random(seed)
    return [("a" if i % 3 == 0 else rng.choice(keys), BASE + dt.timedelta(seconds=step_seconds * rng.randrange(20000)), i) for i in range(n)]


@pytest.mark.parametrize("seed,n,step,minutes,chunk", [
    (1, 500, 60, 60, 24), (2, 800, 7, 60, 1), (3, 300, 900, 60, 2), (4, 400, 1, 5, 1), (5, 200, 3600, 60, 24)])
def test_cooldown_matches_fold(spark, seed, n, step, minutes, chunk):
    rows = make(seed, n, step)
    df = spark.createDataFrame(rows, "type string, timestamp timestamp, id int")
    got = al.apply_cooldown(df, minutes, chunk_hours=chunk)
    assert sorted(r["id"] for r in got.collect()) == fold(rows, minutes)


def test_cooldown_boundary_is_kept(spark):
    rows = [("a", BASE, 0), ("a", BASE + dt.timedelta(minutes=59, seconds=59), 1), ("a", BASE + dt.timedelta(minutes=60), 2)]
    df = spark.createDataFrame(rows, "type string, timestamp timestamp, id int")
    assert sorted(r["id"] for r in al.apply_cooldown(df).collect()) == [0, 2]


def test_cooldown_uses_state(spark):
    rows = make(9, 300, 60)
    df = spark.createDataFrame(rows, "type string, timestamp timestamp, id int")
    kept_at = BASE + dt.timedelta(minutes=200)
    micros = int((kept_at - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    state = spark.createDataFrame([("a", micros)], "type string, last_kept bigint")
    got = sorted(r["id"] for r in al.apply_cooldown(df, state=state).collect())
    assert got == fold(rows, 60, {"a": kept_at})


def test_chunk_steps_agree_with_walking():
    rng = np.random.default_rng(3)
    for _ in range(50):
        times = np.unique(rng.integers(0, 500, 40))
        upper, ends = al.chunk_steps(times, 0, 60)
        for last in range(-120, 0, 7):
            expect, state = None, last
            for x in times:
                if x >= state + 60:
                    state = expect = x
            i = np.searchsorted(upper, last + 60, side="left")
            assert (ends[i] if i < len(upper) else None) == expect


def test_stream_cooldown_over_several_batches(spark):
    """Batches in time order give the fold over all alerts; the state carries across them."""
    rows = sorted(make(11, 400, 60), key=lambda r: r[1])
    src = scratch_path(spark, "alerts")
    for i in range(0, 400, 100):
        spark.createDataFrame(rows[i:i + 100], "type string, timestamp timestamp, id int").coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    out, state, checkpoint = (scratch_path(spark, n) for n in ("kept", "state", "checkpoint"))
    stream = streams.read_stream(spark, src, schema, max_files=1)
    streams.stream_cooldown(stream, out, state, checkpoint).awaitTermination()
    batches = spark.read.parquet(out).select("batch").distinct().count()
    assert batches > 1
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == fold(rows, 60)


def test_moderate_band_uses_its_own_threshold(spark):
    df = spark.createDataFrame([("s", BASE, 40.0, 20.0, 50.0)], "native_sensor_id string, timestamp timestamp, pm25 double, temperature double, humidity double")
    row = al.threshold_alerts(df).collect()
    assert [(r["level"], r["threshold"], r["id"]) for r in row] == [("medium", 35.5, "pm25_20240101_000000")]


def test_zscore_window_and_flat_baseline(spark):
    rows = [("s", BASE + dt.timedelta(days=d, hours=h), "pm25", 10.0 + h) for d in range(5) for h in range(3)]
    rows += [("s", BASE + dt.timedelta(days=5), "pm25", 100.0), ("flat", BASE, "pm25", 1.0), ("flat", BASE, "pm25", 1.0),
             ("flat", BASE + dt.timedelta(days=1), "pm25", 50.0)]
    df = spark.createDataFrame(rows, "native_sensor_id string, timestamp timestamp, metric_name string, value double")
    got = al.zscore_anomalies(df).collect()
    assert [(r["native_sensor_id"], r["value"]) for r in got] == [("s", 100.0)]
    assert got[0]["baseline_mean"] == pytest.approx(11.0)


def test_sensor_health_flags(spark):
    rows = [("run", BASE + dt.timedelta(hours=i), 60.0 + i) for i in range(4)] + [("stuck", BASE + dt.timedelta(hours=i), 5.0) for i in range(4)]
    df = spark.createDataFrame(rows, "native_sensor_id string, timestamp timestamp, pm25 double")
    got = {r["native_sensor_id"]: r for r in al.sensor_health(df, "pm25", BASE + dt.timedelta(hours=5)).collect()}
    assert got["run"]["sustained"] and not got["run"]["stuck"] and not got["run"]["missing_data"]
    assert got["stuck"]["stuck"] and got["stuck"]["repeated_pct"] == 75.0 and not got["stuck"]["sustained"]


def test_auto_resolve_boundary(spark):
    rows = [("a", BASE, "active"), ("b", BASE - dt.timedelta(seconds=1), "active")]
    df = spark.createDataFrame(rows, "id string, timestamp timestamp, status string")
    out = {r["id"]: r["status"] for r in al.auto_resolve(df, BASE + dt.timedelta(hours=2)).collect()}
    assert out == {"a": "active", "b": "auto_resolved"}
    assert al.recent_alerts(df, BASE + dt.timedelta(hours=24)).count() == 0 and F


def test_cooldown_does_not_depend_on_input_order(spark):
    """Alerts of several sensors at one time share an id."""
    rows = [("pm", BASE, "x", s, v) for s, v in (("c", 3.0), ("a", 9.0), ("b", 1.0))]
    schema = "type string, timestamp timestamp, id string, native_sensor_id string, value double"
    kept = {tuple(al.apply_cooldown(spark.createDataFrame(order, schema)).first()) for order in (rows, rows[::-1], rows[1:] + rows[:1])}
    assert kept == {("pm", BASE, "x", "a", 9.0)}


def test_late_alerts_are_kept_apart(spark):
    src, out, state, checkpoint = (scratch_path(spark, n) for n in ("alerts", "kept", "state", "checkpoint"))
    batches = [[("a", BASE + dt.timedelta(hours=5), 1)], [("a", BASE, 2), ("a", BASE + dt.timedelta(hours=7), 3), ("b", BASE, 4)]]
    for rows in batches:
        spark.createDataFrame(rows, "type string, timestamp timestamp, id int").coalesce(1).write.mode("append").parquet(src)
    stream = streams.read_stream(spark, src, "type string, timestamp timestamp, id int", max_files=1)
    streams.stream_cooldown(stream, out, state, checkpoint).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 3, 4]
    assert [r["id"] for r in spark.read.schema("type string, timestamp timestamp, id int").parquet(f"{out}-late/*").collect()] == [2]


def test_unordered_alerts_within_the_lateness_give_the_batch_result(spark):
    rows = make(12, 300, 60)
    shuffled = sorted(rows, key=lambda r: (r[1].timestamp() + (r[2] * 7919) % 20000))
    schema = "type string, timestamp timestamp, id int"
    src, out, state, checkpoint = (scratch_path(spark, n) for n in ("alerts", "kept", "state", "checkpoint"))
    for i in range(0, 300, 60):
        spark.createDataFrame(shuffled[i:i + 60], schema).coalesce(1).write.mode("append").parquet(src)
    stream = streams.read_stream(spark, src, schema, max_files=1)
    streams.stream_cooldown(stream, out, state, checkpoint, lateness="6 hours").awaitTermination()
    waiting = 300 - spark.read.parquet(out).count()
    assert waiting > 0
    streams.release_alerts(spark, stream.schema, out, state, lateness="6 hours")
    assert spark.read.schema(schema).parquet(f"{out}-late/*").count() == 0
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == fold(rows, 60)


def test_hours_late_and_open_rows_are_all_rows(spark):
    schema = "timestamp timestamp, native_sensor_id string, metric_name string, value double"
    src, out, late, state, checkpoint = (scratch_path(spark, n) for n in ("readings", "hours", "late", "state", "checkpoint"))
    draw, total = np.random.default_rng(5), 0
    for batch in range(5):
        rows = [(BASE + dt.timedelta(minutes=int(m) + 60 * batch), f"s{m % 3}", "pm2_5", float(m)) for m in draw.integers(0, 400, 80)]
        total += len(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = streams.read_stream(spark, src, schema, max_files=1)
    streams.stream_hourly_complete(stream, out, late, state, checkpoint, lateness="1 hour").awaitTermination()
    out_rows = spark.read.parquet(out)
    emitted, still = out_rows.agg(F.sum("samples")).first()[0], streams.open_hours(spark, state, "1 hour").agg(F.sum("samples")).first()[0]
    behind = streams.late_counts(spark.read.schema(schema).parquet(f"{late}/*")).agg(F.sum("late_rows")).first()[0]
    assert emitted + still + behind == total and min(emitted, still, behind) > 0
    assert out_rows.groupBy("hour_ts", "native_sensor_id").count().filter("count > 1").count() == 0
