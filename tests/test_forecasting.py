"""Models and the recursive forecast against a plain loop."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aeroloom import vocab
from aeroloom.operators import forecasting as fc, health

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(4)
    rows = [(T0 + dt.timedelta(hours=i), f"s{k}", 20 + 10 * ((i % 24) / 24) + rng.random(), 15.0 + i % 9, 50.0 + k + i % 5)
            for k in range(3) for i in range(120)]
    return spark.createDataFrame(rows, "timestamp timestamp, native_sensor_id string, pm25 double, temperature double, humidity double")


def test_features_leave_the_target_row_out(spark, history):
    row = fc.build_features(history).filter("native_sensor_id = 's0'").orderBy("timestamp").first()
    past = [r["pm25"] for r in history.filter("native_sensor_id = 's0'").orderBy("timestamp").collect()]
    assert row["timestamp"] == T0 + dt.timedelta(hours=24)
    assert row["pm25_lag_24h"] == past[0] and row["pm25_ma_3h"] == pytest.approx(sum(past[21:24]) / 3)
    with_own = fc.build_features(history, include_current=True).filter("native_sensor_id = 's0'").orderBy("timestamp").first()
    assert with_own["pm25_ma_3h"] == pytest.approx(sum(past[22:25]) / 3)


def test_forecast_feeds_predictions_back(spark, history):
    rows = fc.build_features(history)
    model = fc.train_models(rows, vocab.FORECAST_FEATURES, names=["linear_regression"])["linear_regression"]
    current = fc.current_conditions(history)
    got = {(r["native_sensor_id"], r["hours_ahead"]): r for r in fc.forecast(model, current, 30, cut_every=10).collect()}
    assert len(got) == 90
    scaler, linear = model.stages[1], model.stages[2]
    now = current.filter("native_sensor_id = 's1'").first()
    recent = [now["pm25"]]
    back = lambda n: recent[-n] if len(recent) >= n else now["pm25"]
    mean = lambda n: sum(recent[-n:]) / n if len(recent) >= n else now["pm25"]
    for hour in range(1, 31):
        at = now["timestamp"] + dt.timedelta(hours=hour)
        x = [at.hour, at.weekday(), at.month, now["temperature"], now["humidity"], *[back(n) for n in vocab.LAGS], *[mean(n) for n in vocab.MOVING_AVERAGES]]
        # A feature without variation scales to zero.
        z = [(v - m) / s if s else 0.0 for v, m, s in zip(x, scaler.mean, scaler.std)]
        value = min(max(sum(c * v for c, v in zip(linear.coefficients, z)) + linear.intercept, 0.0), 500.0)
        r = got["s1", hour]
        assert r["predicted_pm25"] == pytest.approx(value, abs=0.051) and r["timestamp"] == at
        assert r["confidence"] == ("high" if hour <= 6 else "medium" if hour <= 24 else "low")
        recent.append(value)


def test_any_number_of_hours_is_forecast_and_summarised(spark, history):
    model = fc.train_models(fc.build_features(history), vocab.FORECAST_FEATURES, names=["linear_regression"])["linear_regression"]
    out = fc.forecast(model, fc.current_conditions(history), 99, cut_every=24)
    assert out.agg(F.max("hours_ahead")).first()[0] == 99
    with pytest.raises(ValueError):
        fc.forecast(model, fc.current_conditions(history), 0)
    assert fc.forecast_summary(out).first()["min"] <= fc.forecast_summary(out).first()["max"]
    assert health.forecast_advisory(out).count() == 1


def test_too_few_rows_are_refused(spark, history):
    with pytest.raises(ValueError):
        fc.train_models(fc.build_features(history).limit(10), vocab.FORECAST_FEATURES)


def test_evaluation_marks_the_best(spark, history):
    rows = fc.build_features(history)
    models = fc.train_models(rows, vocab.FORECAST_FEATURES, names=["linear_regression"])
    out = fc.evaluate({"first": models["linear_regression"], "second": models["linear_regression"]}, rows).collect()
    assert [r["model"] for r in out if r["best"]] == ["first"] and all(r["rmse"] >= r["mae"] > 0 for r in out)
