"""Features and models (section 2.12, M6-M12)."""

from pyspark.sql import functions as F

from aeroloom.operators import forecasting as fc, timeseries
from aeroloom.session import scratch_path
from aeroloom.vocab import FORECAST_FEATURES
from verification.registry import add

_BY = "OVER (PARTITION BY native_sensor_id ORDER BY timestamp, event_id"
_MADE = ("(SELECT *, hour(timestamp)::INT AS hour, (isodow(timestamp) - 1)::INT AS day_of_week, month(timestamp)::INT AS month, "
         + ", ".join(f"lag(pm25, {n}) {_BY}) AS pm25_lag_{n}h" for n in (1, 6, 12, 24)) + ", "
         + ", ".join(f"avg(pm25) {_BY} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS pm25_ma_{n}h" for n in (3, 6, 24)) + " FROM history)")
_DOUBLES = "pm25 temperature humidity pm25_lag_1h pm25_lag_6h pm25_lag_12h pm25_lag_24h pm25_ma_3h pm25_ma_6h pm25_ma_24h"


def _features(d):
    return fc.build_features(d.history(), ties=["event_id"])


def _split(d):
    rows = timeseries.chrono_split(_features(d), "timestamp", ties=["event_id"])
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


add("m06_build_features", _features, f"SELECT * FROM {_MADE} WHERE pm25_lag_24h IS NOT NULL", _DOUBLES)


def _scaled(d):
    """Mean and deviation of every feature of the training rows, as the scaler fitted them."""
    train, _ = _split(d)
    _, scaler = fc.fit_scaler(train, FORECAST_FEATURES)
    rows = [(f, float(m), float(s)) for f, m, s in zip(FORECAST_FEATURES, scaler.mean, scaler.std)]
    out = d.spark.createDataFrame(rows, "feature string, mean double, sd double")
    return out.select("feature", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"))


_TRAIN = f"""(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY timestamp, event_id) AS rn, count(*) OVER () AS n FROM {_MADE}
    WHERE pm25_lag_24h IS NOT NULL) WHERE rn <= floor(0.8::DOUBLE * n))"""
add("m07_fit_scaler", _scaled, " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(avg({f}), 4) AS mean, round(stddev_samp({f}), 4) AS sd FROM {_TRAIN}" for f in FORECAST_FEATURES), "mean sd")


def _trained(d, names=None):
    train, test = _split(d)
    return fc.train_models(train, FORECAST_FEATURES, names=names), train, test


def _evaluated(d):
    models, _, test = _trained(d)
    return fc.evaluate(models, test)


add("m08_m09_train_and_evaluate", _evaluated)

# The linear model on one feature has a closed form, so its training, scores and forecast can be compared.
_ONE = ["pm25_lag_1h"]
_PARTS = f"""(SELECT *, rn <= floor(0.8::DOUBLE * n) AS train FROM (SELECT *, row_number() OVER (ORDER BY timestamp, event_id) AS rn, count(*) OVER () AS n
    FROM {_MADE} WHERE pm25_lag_24h IS NOT NULL))"""
_LINE = f"""(SELECT regr_slope(pm25, pm25_lag_1h) AS a, regr_intercept(pm25, pm25_lag_1h) AS b FROM {_PARTS} WHERE train)"""
_SCORES = f"""SELECT 'linear_regression' AS model, round(avg(abs(e)), 5) AS mae, round(avg(e * e), 5) AS mse, round(sqrt(avg(e * e)), 5) AS rmse,
    round(1 - sum(e * e) / (var_pop(pm25) * count(*)), 5) AS r2, count(*)::BIGINT AS samples, true AS best
    FROM (SELECT pm25, pm25 - (a * pm25_lag_1h + b) AS e FROM {_PARTS}, {_LINE} WHERE NOT train)"""


def _simple(d):
    train, test = _split(d)
    return fc.train_models(train, _ONE, names=["linear_regression"])["linear_regression"], train, test


def _rounded(metrics):
    return metrics.withColumns({c: F.round(c, 5) for c in ("mae", "mse", "rmse", "r2")})


def _coefficients(d):
    """Slope and intercept on the unscaled feature."""
    model, _, _ = _simple(d)
    scaler, linear = model.stages[1], model.stages[2]
    slope = float(linear.coefficients[0]) / float(scaler.std[0])
    row = (slope, float(linear.intercept) - slope * float(scaler.mean[0]))
    return d.spark.createDataFrame([row], "slope double, intercept double").select(F.round("slope", 5).alias("slope"), F.round("intercept", 4).alias("intercept"))


def _simple_scores(d):
    model, _, test = _simple(d)
    return _rounded(fc.evaluate({"linear_regression": model}, test))


add("m08_linear_coefficients", _coefficients, f"SELECT round(a, 5) AS slope, round(b, 4) AS intercept FROM {_LINE}")
add("m09_linear_scores", _simple_scores, _SCORES)


def _saved(d):
    models, _, test = _trained(d, ["linear_regression"])
    path = scratch_path(d.spark, "model")
    fc.save_model(models["linear_regression"], path)
    return fc.evaluate({"linear_regression": fc.load_model(path)}, test)


add("m10_save_model", _saved)


def _saved_simple(d):
    """The saved and the loaded model, row by row."""
    model, _, test = _simple(d)
    path = scratch_path(d.spark, "model")
    fc.save_model(model, path)
    return fc.load_model(path).transform(test).select("event_id", F.round("prediction", 5).alias("prediction"))


add("m10_loaded_predictions", _saved_simple, f"SELECT event_id, round(a * pm25_lag_1h + b, 5) AS prediction FROM {_PARTS}, {_LINE} WHERE NOT train")


def _forecast(d, hours=48):
    models, _, _ = _trained(d, ["linear_regression"])
    return fc.forecast(models["linear_regression"], fc.current_conditions(d.history(), ties=["event_id"]), hours)


add("m11_forecast", _forecast)


def _simple_forecast(d, hours=30):
    model, _, _ = _simple(d)
    current = fc.current_conditions(d.history(), ties=["event_id"])
    return fc.forecast(model, current, hours), current


_NOW = """(SELECT native_sensor_id, arg_max(pm25, (timestamp, event_id)) AS pm25, max(timestamp) AS since FROM history GROUP BY 1)"""
_AHEAD = f"""(WITH RECURSIVE line AS {_LINE}, f AS (SELECT native_sensor_id, since, 0 AS h, pm25 AS v FROM {_NOW} UNION ALL
    SELECT native_sensor_id, since, h + 1, least(greatest(a * v + b, 0), 500) FROM f, line WHERE h < 30) SELECT * FROM f WHERE h > 0)"""
add("m11_linear_forecast", lambda d: _simple_forecast(d)[0].select("native_sensor_id", "timestamp", F.col("hours_ahead").cast("int").alias("hours_ahead"), "predicted_pm25", "confidence"),
    f"""SELECT native_sensor_id, since + to_hours(h) AS timestamp, h AS hours_ahead, round(v, 1) AS predicted_pm25,
        CASE WHEN h <= 6 THEN 'high' WHEN h <= 24 THEN 'medium' ELSE 'low' END AS confidence FROM {_AHEAD}""", "predicted_pm25")


def _simple_summary(d):
    made, current = _simple_forecast(d)
    out = fc.forecast_summary(made, "native_sensor_id", "linear_regression", _ONE, current)
    return out.withColumn("features", F.concat_ws(",", "features"))


add("m12_linear_summary", _simple_summary,
    f"""SELECT native_sensor_id, round(min(round(v, 1)), 1) AS min, round(max(round(v, 1)), 1) AS max, round(avg(round(v, 1)), 1) AS avg,
        'linear_regression' AS model, 'pm25_lag_1h' AS features, any_value(n.pm25) AS baseline FROM {_AHEAD} f JOIN {_NOW} n USING (native_sensor_id)
        GROUP BY 1""", "min max avg baseline")
add("m12_forecast_summary", lambda d: fc.forecast_summary(_forecast(d, 24), "native_sensor_id"))


def _metadata(d):
    models, train, test = _trained(d, ["linear_regression"])
    meta = fc.model_metadata(fc.evaluate(models, test), FORECAST_FEATURES, train.count(), "2024-01-31 00:00:00")
    return meta.select("best_model", "training_date", F.size("feature_columns").cast("bigint").alias("features"), "training_samples")


add("m09_model_metadata", _metadata,
    f"""SELECT 'linear_regression' AS best_model, timestamp '2024-01-31' AS training_date, 12::BIGINT AS features, count(*)::BIGINT AS training_samples
        FROM {_TRAIN}""")
