"""PM2.5 forecasting: features, Spark ML models, evaluation and recursive prediction."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from aeroloom import vocab
from aeroloom.functions import air
from aeroloom.functions.numbers import exact_round
from aeroloom.functions.times import time_features
from aeroloom.operators.timeseries import history_features, last_n
from aeroloom.session import materialize, shared_dir


def build_features(df: DataFrame, key: str = "native_sensor_id", ts: str = "timestamp", target: str = "pm25",
                   include_current: bool = False, ties=()) -> DataFrame:
    """Feature rows of each sensor; rows lacking the target or a feature are dropped.

    Temperature and humidity take part when the input has them.  Moving averages leave the target's own row
    out unless ``include_current`` is set.
    """
    rows = df.filter(F.col(target).isNotNull() & F.col(ts).isNotNull())
    made = history_features(rows, key, ts, target, include_current, ties)
    made = time_features(made, ts).drop("season")
    features = feature_names(made.columns)
    if len(features) < 3:
        raise ValueError(f"at least three features are needed, found {features}")
    return made.dropna(subset=[target, *features])


def feature_names(columns) -> list[str]:
    return [f for f in vocab.FORECAST_FEATURES if f in set(columns)]


def fit_scaler(train: DataFrame, cols):
    """(assembler, fitted scaler) of the training rows; apply both to the test rows."""
    assembler = VectorAssembler(inputCols=list(cols), outputCol="features")
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return assembler, scaler.fit(assembler.transform(train))


def estimators(seed: int = 42) -> dict:
    """Fixed model settings: 50 trees of depth 10, 50 boosting rounds of depth 6, and least squares."""
    return {
        "random_forest": RandomForestRegressor(numTrees=50, maxDepth=10, featureSubsetStrategy="all", seed=seed,
                                               maxMemoryInMB=1024),
        "gradient_boosting": GBTRegressor(maxIter=50, maxDepth=6, stepSize=0.1, seed=seed),
        "linear_regression": LinearRegression(),
    }


def train_models(train: DataFrame, features, target: str = "pm25", seed: int = 42, names=None,
                 min_rows: int = 50) -> dict[str, PipelineModel]:
    """One fitted pipeline per model; only the linear one scales its inputs."""
    shared_dir(train.sparkSession)
    data = train.select(F.col(target).cast("double").alias("label"), *features).persist()
    try:
        if data.limit(min_rows).count() < min_rows:
            raise ValueError(f"at least {min_rows} training rows are needed")
        out = {}
        for name, model in estimators(seed).items():
            if names is not None and name not in names:
                continue
            stages = [VectorAssembler(inputCols=list(features), outputCol="features")]
            if name == "linear_regression":
                stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
                model = model.copy({model.featuresCol: "scaled"})
            out[name] = Pipeline(stages=[*stages, model]).fit(data)
        return out
    finally:
        data.unpersist()


def evaluate(models: dict[str, PipelineModel], test: DataFrame, target: str = "pm25") -> DataFrame:
    """MAE, MSE, RMSE and R2 per model, the one with the smallest MAE marked best."""
    out = None
    for order, (name, model) in enumerate(models.items()):
        scored = model.transform(test.withColumn("label", F.col(target).cast("double")))
        err = F.col("label") - F.col("prediction")
        part = scored.agg(
            F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"), F.sum(err * err).alias("sse"),
            (F.var_pop("label") * F.count("label")).alias("sst"), F.count("label").alias("samples"))
        part = part.select(F.lit(order).alias("position"), F.lit(name).alias("model"), "mae", "mse",
                           F.sqrt("mse").alias("rmse"), (1 - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"), "samples")
        out = part if out is None else out.unionByName(part)
    # One row per model.
    w = Window.orderBy("mae", "position")
    return out.withColumn("best", F.row_number().over(w) == 1).drop("position")


def best_model(metrics: DataFrame) -> str:
    return metrics.filter("best").first()["model"]


def model_metadata(metrics: DataFrame, features, trained_rows: int, trained_at) -> DataFrame:
    """One row: best model, time, features, rows and the performance of all models."""
    perf = F.map_from_entries(F.collect_list(F.struct("model", F.struct("mae", "rmse", "r2"))))
    return metrics.agg(F.max(F.when(F.col("best"), F.col("model"))).alias("best_model"), perf.alias("model_performance")).select(
        "best_model", F.lit(str(trained_at)).cast("timestamp").alias("training_date"),
        F.array(*[F.lit(f) for f in features]).alias("feature_columns"),
        F.lit(trained_rows).cast("bigint").alias("training_samples"), "model_performance")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def current_conditions(df: DataFrame, ts: str = "timestamp", key: str = "native_sensor_id", ties=()) -> DataFrame:
    """Latest reading per sensor."""
    return last_n(df, ts, 1, key, ties)


def _normal(key: Column, hour: int, seed: int) -> Column:
    """Standard normal value of a sensor and an hour, whatever task reckons it (Box-Muller over two hashes)."""
    u = [(F.pmod(F.xxhash64(key, F.lit(hour), F.lit(seed), F.lit(k)), F.lit(1 << 52)) + 0.5) / float(1 << 52) for k in (1, 2)]
    return F.sqrt(-2.0 * F.log(u[0])) * F.cos(2.0 * F.pi() * u[1])


def forecast(model: PipelineModel, current: DataFrame, hours: int = 24, noise: float = 0.0, seed: int = 42,
             start=None, key: str = "native_sensor_id", ts: str = "timestamp", cut_every: int = 12) -> DataFrame:
    """Hourly forecast per sensor, each hour fed by the predictions before it.

    ``current`` has one row per sensor.  Missing values take the defaults.  A lag longer than the predictions
    made so far is the current value, and so is an average over too few.  Predictions are clamped to 0..500;
    ``noise`` adds that share of normal variation, drawn from sensor, hour and seed.  Hours count from ``start``, by
    default from each sensor's latest reading.

    All sensors advance together; the state is one short array per sensor, checkpointed every few hours.
    """
    if hours < 1:
        raise ValueError("a forecast has at least one hour")
    base = F.lit(str(start)).cast("timestamp") if start is not None else F.col(ts).cast("timestamp")
    default = lambda name: (F.coalesce(F.col(name).cast("double"), F.lit(vocab.FORECAST_DEFAULTS[name]))
                            if name in current.columns else F.lit(vocab.FORECAST_DEFAULTS[name]))
    state = current.select(
        F.col(key), base.alias("base_time"), default("pm25").alias("pm25"), default("temperature").alias("temperature"),
        default("humidity").alias("humidity"),
        F.array(default("pm25")).alias("recent"), F.array().cast("array<double>").alias("made"))
    keep = state.columns

    def back(n: int) -> Column:
        return F.when(F.size("recent") >= n, F.element_at("recent", F.when(F.size("recent") >= n, -n).otherwise(-1))).otherwise(F.col("pm25"))

    def mean(n: int) -> Column:
        tail = F.slice("recent", F.greatest(F.size("recent") - (n - 1), F.lit(1)), n)
        return (F.when(F.size("recent") >= n, F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / n)
                .otherwise(F.col("pm25")))

    for hour in range(1, hours + 1):
        at = F.col("base_time") + F.expr(f"interval {hour} hours")
        step = state.withColumns({
            "hour": F.hour(at), "day_of_week": F.weekday(at), "month": F.month(at),
            **{f"pm25_lag_{n}h": back(n) for n in vocab.LAGS}, **{f"pm25_ma_{n}h": mean(n) for n in vocab.MOVING_AVERAGES}})
        value = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(500.0))
        scored = model.transform(step).withColumn("value", value)
        if noise:
            scored = scored.withColumn("value", F.greatest(F.col("value") * (1 + _normal(F.col(key), hour, seed) * noise), F.lit(0.0)))
        state = scored.withColumns({
            "recent": F.slice(F.concat("recent", F.array("value")), F.greatest(F.size("recent") - 22, F.lit(1)), 24),
            "made": F.concat("made", F.array("value"))}).select(*keep)
        if hour % cut_every == 0 and hour < hours:
            state = materialize(state)

    lines = state.select(key, "base_time", F.posexplode("made").alias("at", "value"))
    ahead = (F.col("at") + 1).alias("hours_ahead")
    return lines.select(
        key, (F.col("base_time") + F.make_interval(hours=F.col("at") + 1)).alias("timestamp"), ahead,
        exact_round(F.col("value"), 1).alias("predicted_pm25"), air.health_category(F.col("value")).alias("health_category"),
        air.aqi(F.col("value")).alias("aqi"), air.confidence(F.col("at") + 1).alias("confidence"))


def forecast_summary(predictions: DataFrame, key: str | None = None, model: str | None = None, features=(),
                     current: DataFrame | None = None, target: str = "pm25") -> DataFrame:
    """Least, largest and mean prediction, of all or per key; with ``model`` also its name, features and the baseline:
    the current value the forecast set out from (its mean, without ``key``)."""
    by = [key] if key else []
    v = "predicted_pm25"
    out = predictions.groupBy(*by).agg(
        exact_round(F.min(v), 1).alias("min"), exact_round(F.max(v), 1).alias("max"), exact_round(F.avg(v), 1).alias("avg"))
    if model is None:
        return out
    out = out.withColumns({"model": F.lit(model), "features": F.array(*[F.lit(f) for f in features]).cast("array<string>")})
    if current is None:
        return out
    base = F.coalesce(F.col(target).cast("double"), F.lit(vocab.FORECAST_DEFAULTS[target]))
    if key:
        return out.join(current.select(key, base.alias("baseline")), key, "left")
    return out.withColumn("baseline", current.agg(F.avg(base)).scalar())
