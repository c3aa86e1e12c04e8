"""Analysis of a history: preparation, models, forecast, seasons and health in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aeroloom.operators import filters, forecasting, health, timeseries
from aeroloom.session import materialize


def prepared(history: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Plausible readings with a time; what the models and the reports are made from."""
    return filters.require(filters.plausible(history), [ts])


def analyse(history: DataFrame, hours: int = 24, models=None, train_share: float = 0.8, key: str = "native_sensor_id", ts: str = "timestamp",
            target: str = "pm25", ties=(), seed: int = 42) -> dict[str, DataFrame]:
    """Results by name for a history of readings (key, ts, target and, if present, temperature and humidity):

    ``metrics`` of each model on the last part of the rows, ``forecast`` of the best one per sensor and its ``summary``,
    ``seasonal`` statistics by month and season, the ``trend``, and the ``health`` report of the last week.
    """
    rows = prepared(history, ts)
    features = forecasting.build_features(rows, key, ts, target, ties=ties)
    # Both parts are read once per model.
    split = materialize(timeseries.chrono_split(features, ts, train_share, ties=ties))
    names = forecasting.feature_names(split.columns)
    fitted = forecasting.train_models(split.filter("split = 'train'"), names, target, seed, models)
    metrics = materialize(forecasting.evaluate(fitted, split.filter("split = 'test'"), target))
    best = forecasting.best_model(metrics)
    current = forecasting.current_conditions(rows, ts, key, ties)
    ahead = forecasting.forecast(fitted[best], current, hours, seed=seed, key=key, ts=ts)
    daily = timeseries.daily_means(rows, ts, target)
    return {"metrics": metrics, "forecast": ahead, "summary": forecasting.forecast_summary(ahead, key, best, names, current, target),
            "seasonal": timeseries.calendar_stats(rows, ts, target), "trend": timeseries.trend_change(daily),
            "health": health.health_report(rows, ts, target, ties=ties)}
