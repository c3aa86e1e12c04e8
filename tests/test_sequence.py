"""Skew-safe sequences against brute force on small frames."""

import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aeroloom.operators import sequence, timeseries as t


def _frame(spark, seed=1):
    """One key holds a third of all rows; one key is null; times are uneven."""
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        at = pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=rng.choice([1, 60, 3600]) * rng.randrange(500))
        rows.append((i, key, at.to_pydatetime(), rng.choice([None, float(rng.randrange(20)), rng.random() * 1e6 - 10])))
    return spark.createDataFrame(rows, "id int, key string, ts timestamp, v double")


def test_sequence_rows_and_lookback_match_pandas(spark):
    df = _frame(spark)
    seq = sequence.sequence_rows(df, ["key"], "ts", ["id"], run_bits=3)
    made = {"back3": lambda w: F.lag("v", 3).over(w), "sum4": lambda w: F.sum("v").over(w.rowsBetween(-3, 0))}
    got = sequence.lookback(seq, ["key"], 3, made, block_rows=5).toPandas().sort_values("id").reset_index(drop=True)
    assert len(got) == 600
    want = df.toPandas().sort_values(["ts", "id"])
    groups = want.groupby("key", dropna=False, sort=False)
    want["seq"] = groups.cumcount() + 1
    want["key_rows"] = groups["id"].transform("size")
    want["back3"] = groups["v"].shift(3)
    want["sum4"] = groups["v"].transform(lambda s: s.rolling(4, min_periods=1).sum())
    want = want.sort_values("id").reset_index(drop=True)
    for c in ("seq", "key_rows", "back3", "sum4"):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-6, equal_nan=True, err_msg=c)


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.75, 1.0])
def test_exact_quantile_matches_pandas(spark, q):
    df = _frame(spark, 2)
    got = {r["key"]: r["m"] for r in sequence.exact_quantile(df, ["key"], "v", q, "m", run_bits=4).collect()}
    want = df.toPandas().groupby("key", dropna=False)["v"].quantile(q)
    assert len(got) == len(want)
    for key, value in want.items():
        assert got[None if pd.isna(key) else key] == pytest.approx(value, rel=1e-12)


@pytest.mark.parametrize("descending", [True, False])
def test_rank_within_matches_pandas(spark, descending):
    df = _frame(spark, 3)
    got = sequence.rank_within(df, ["key"], "v", "r", run_bits=4, descending=descending).toPandas().sort_values("id")
    want = df.toPandas().sort_values("id")
    want["r"] = want.groupby("key", dropna=False)["v"].rank(method="min", ascending=not descending, na_option="bottom")
    np.testing.assert_array_equal(got["r"].to_numpy(), want["r"].astype(int).to_numpy())


def test_chrono_split_counts(spark):
    out = t.chrono_split(_frame(spark), "ts", 0.8, ties=["id"])
    counts = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert counts == {"train": 480, "test": 120}
    ends = out.groupBy("split").agg(F.max("ts").alias("hi"), F.min("ts").alias("lo")).collect()
    by = {r["split"]: r for r in ends}
    assert by["train"]["hi"] <= by["test"]["lo"]


def test_cadence_median_at_the_limit(spark):
    """Half of the gaps short and half long: the median is the mean of the two middle ones."""
    def gaps(key, minutes):
        at, rows = pd.Timestamp("2024-01-01"), []
        for m in [0, *minutes]:
            at += pd.Timedelta(minutes=m)
            rows.append((key, at.to_pydatetime()))
        return rows
    rows = gaps("short", [10, 15, 22, 60]) + gaps("long", [10, 19, 40, 60]) + gaps("odd", [5, 20, 90]) + gaps("one", [])
    df = spark.createDataFrame(rows, "key string, ts timestamp")
    got = {r["key"]: r["step_seconds"] for r in t.cadence(df, "key", "ts").collect()}
    assert got == {"short": 900, "long": 3600, "odd": 900, "one": None}


def _decompose_by_formula(x, period):
    """Centred moving average, extended by least squares, in exact fractions."""
    x = [Fraction(v) for v in x]
    n, half = len(x), period // 2
    weights = [Fraction(1, period)] * period if period % 2 else (
        [Fraction(1, 2 * period)] + [Fraction(1, period)] * (period - 1) + [Fraction(1, 2 * period)])
    trend = [None] * n
    for i in range(half, n - half):
        trend[i] = sum(w * x[i - half + k] for k, w in enumerate(weights))
    first, last = half, n - 1 - half

    def line(points):
        m = len(points)
        mx, my = sum(Fraction(p) for p in points) / m, sum(trend[p] for p in points) / m
        slope = sum((p - mx) * (trend[p] - my) for p in points) / sum((p - mx) ** 2 for p in points)
        return slope, my - slope * mx
    a, b = line(range(first, min(first + period - 1, last)))
    c, e = line(range(max(first, last - period + 1), last))
    for i in range(first):
        trend[i] = a * i + b
    for i in range(last + 1, n):
        trend[i] = c * i + e
    detrended = [v - w for v, w in zip(x, trend)]
    phases = [sum(detrended[p::period]) / len(detrended[p::period]) for p in range(period)]
    grand = sum(phases) / period
    return [(float(trend[i]), float(phases[i % period] - grand)) for i in range(n)]


@pytest.mark.parametrize("n,period", [(33, 7), (41, 8), (60, 15), (130, 30)])
def test_decompose_matches_formula(spark, n, period):
    rng = random.Random(n)
    x = [rng.randrange(100) + (i % period) * 2 for i in range(n)]
    rows = [("k", (pd.Timestamp("2024-01-01") + pd.Timedelta(days=i)).date(), float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "key string, day date, value double")
    got = t.decompose(df, "key", period).orderBy("day").collect()
    assert len(got) == n
    for r, (trend, seasonal) in zip(got, _decompose_by_formula(x, period)):
        assert r["trend"] == pytest.approx(trend, abs=1e-9)
        assert r["seasonal"] == pytest.approx(seasonal, abs=1e-9)
        assert r["resid"] == pytest.approx(r["value"] - trend - seasonal, abs=1e-9)


def test_decompose_default_period_and_short_series(spark):
    rows = [(k, (pd.Timestamp("2024-01-01") + pd.Timedelta(days=i)).date(), float(i % 5))
            for k, n in (("long", 40), ("short", 29)) for i in range(n)]
    out = t.decompose(spark.createDataFrame(rows, "key string, day date, value double"), "key")
    assert {(r["key"], r["period"]) for r in out.collect()} == {("long", 10)}


def _rows_per_task(spark, df, run):
    """Largest number of rows that a task held of the frame that ``run`` gives."""
    return run(df).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]


@pytest.fixture
def without_broadcasts(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hot_key_is_spread_without_a_broadcast(spark, without_broadcasts):
    """Half of all rows are one key's: no task of the ranges, the runs or the blocks gets more than two even shares."""
    share = 40_000 // 16
    df = spark.range(40_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('k', id % 400) END AS key",
                                        "timestamp_seconds(1700000000 + id * 7) AS ts", "CAST(id % 13 AS DOUBLE) AS v")
    numbered = lambda d: sequence.sequence_rows(d, ["key"], "ts", ["id"], run_bits=7)
    assert _rows_per_task(spark, df, lambda d: d.repartitionByRange(16, "key", "ts", "id")) < 2 * share
    assert _rows_per_task(spark, df, numbered) < 2 * share
    looked = lambda d: sequence.lookback(numbered(d), ["key"], 3, {"back": lambda w: F.lag("v", 3).over(w)}, block_rows=128)
    assert _rows_per_task(spark, df, looked) < 2 * share
    assert looked(df).filter("key = 'hot'").agg(F.max("seq")).first()[0] == 20_000


def test_one_metric_is_spread_without_a_broadcast(spark, without_broadcasts):
    """Selection within one metric, one value of it far off: as above, and the results are exact."""
    share = 40_000 // 16
    df = spark.range(40_000).selectExpr("id", "'pm2_5' AS metric", "CASE WHEN id = 7 THEN 1e18D ELSE CAST(id * 7919 % 40009 AS DOUBLE) END AS v")
    ranked = lambda d: sequence.rank_within(d, ["metric"], "v", "r", run_bits=7)
    assert _rows_per_task(spark, df, ranked) < 2 * share
    counts = df.groupBy("metric", "v").agg(F.count("*").alias("n"))
    assert _rows_per_task(spark, counts, lambda d: sequence.number_rows(d, ["metric"], ["v"], "start", "rows", "n", 7)) < 2 * share
    want = df.toPandas()
    assert sequence.exact_quantile(df, ["metric"], "v", 0.5, "m", run_bits=7).first()["m"] == want["v"].median()
    got = ranked(df).toPandas().sort_values("id")["r"].to_numpy()
    np.testing.assert_array_equal(got, want.sort_values("id")["v"].rank(method="min", ascending=False).astype(int).to_numpy())


def test_rows_without_a_time_stay(spark):
    rows = [(i, "k", None if i % 4 == 0 else (pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)).to_pydatetime(), float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, key string, ts timestamp, v double")
    out = {r["id"]: r for r in t.lag_features(df, "key", "ts", "v").collect()}
    assert len(out) == 12 and all(out[i]["v_lag_1h"] is None for i in (0, 4, 8)) and out[2]["v_lag_1h"] == 1.0
    split = {r["id"]: r["split"] for r in t.chrono_split(df, "ts").collect()}
    assert [i for i, s in split.items() if s is None] == [0, 4, 8] and split[11] == "test"


def test_short_series_are_named(spark):
    rows = [(k, (pd.Timestamp("2024-01-01") + pd.Timedelta(days=i)).date(), float(i % 5)) for k, n in (("long", 40), ("short", 29)) for i in range(n)]
    got = {r["key"]: (r["days"], r["status"]) for r in t.decompose_status(spark.createDataFrame(rows, "key string, day date, value double"), "key").collect()}
    assert got == {"long": (40, "ok"), "short": (29, "too short")}


def test_cadence_scans_little(spark):
    df = _frame(spark).filter("key IS NOT NULL")
    summary, _ = t.cadence_gaps(df, "key", "ts")
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 4
