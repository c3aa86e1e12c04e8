"""Dashboard and report queries over the enriched daily table.

Metric names and dates are parameters; every report is one grouped aggregate over a pruned date range.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from aeroloom.functions import air
from aeroloom.functions.times import as_date, days_between, week_of_year
from aeroloom.operators.filters import active_or_unknown, any_bound
from aeroloom.operators.sequence import exact_quantile


def since(df: DataFrame, start, ts: str = "day_ts") -> DataFrame:
    return df.filter(F.col(ts) >= F.lit(as_date(start).isoformat()).cast(df.schema[ts].dataType))


def _day(ts: str = "day_ts"):
    return F.to_date(ts).alias("date")


def latest_active(df: DataFrame, start) -> DataFrame:
    """Daily rows of active sensors since ``start``."""
    return active_or_unknown(since(df, start)).select(
        "day_ts", "native_sensor_id", "metric_name", "avg_value", "min_value", "max_value", "samples",
        "latitude", "longitude")


def sensor_summary(df: DataFrame, start) -> DataFrame:
    """Metrics, days, last reading and mean daily samples per sensor and status."""
    return since(df, start).groupBy("native_sensor_id", "status").agg(
        F.count_distinct("metric_name").alias("metrics_count"),
        F.count_distinct(F.to_date("day_ts")).alias("days_active"),
        F.max("day_ts").alias("last_reading"), F.avg("samples").alias("avg_samples_per_day"))


def metric_trend(df: DataFrame, metric: str, start) -> DataFrame:
    """Per day and sensor: average of averages, minimum of minima, maximum of maxima."""
    return (active_or_unknown(since(df.filter(F.col("metric_name") == metric), start))
            .groupBy(_day(), "native_sensor_id")
            .agg(F.avg("avg_value").alias("avg_value"), F.min("min_value").alias("min_value"),
                 F.max("max_value").alias("max_value")))


def low_samples(df: DataFrame, start, limit: int = 10) -> DataFrame:
    return active_or_unknown(since(df, start)).filter(F.col("samples") < limit).select(
        "native_sensor_id", "metric_name", _day(), "samples", "avg_value")


def coverage_pct(df: DataFrame, start, days: int = 30) -> DataFrame:
    n = F.count_distinct(F.to_date("day_ts"))
    return since(df, start).groupBy("native_sensor_id").agg(
        n.alias("days_with_data"), F.count_distinct("metric_name").alias("metrics_reported"),
        F.round(n / float(days) * 100, 1).alias("coverage_percent"))


def pm25_daily(df: DataFrame, metric: str, start) -> DataFrame:
    """Daily PM2.5 with its coarse AQI category."""
    return (active_or_unknown(since(df.filter(F.col("metric_name") == metric), start)).groupBy(_day())
            .agg(F.avg("avg_value").alias("avg_pm25"), F.min("min_value").alias("min_pm25"),
                 F.max("max_value").alias("max_pm25"), F.count_distinct("native_sensor_id").alias("sensors_reporting"))
            .withColumn("aqi_category", air.aqi_bucket(F.col("avg_pm25"))))


def metric_matrix(df: DataFrame, keys, metrics, value: str = "avg_value", last_reading: str | None = None) -> DataFrame:
    """One column per listed metric: the largest ``value`` per key.

    The metrics are given, so no pass over the data is needed to find the columns.  With ``last_reading``, the name of a
    time column, its largest value comes along under that name.
    """
    more = [F.max(last_reading).alias("last_reading")] if last_reading else []
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col("metric_name") == m, F.col(value))).alias(m) for m in metrics], *more)


def latest_positions(df: DataFrame, ts: str = "day_ts", per_sensor: bool = False) -> DataFrame:
    """Active rows of the table's latest day, with or without a location.

    ``per_sensor`` takes each sensor's own latest day with a location instead, and only rows that have one.
    """
    if not per_sensor:
        return active_or_unknown(df.filter(F.col(ts) == df.agg(F.max(ts)).scalar()))
    rows = active_or_unknown(df).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    days = rows.groupBy("native_sensor_id").agg(F.max(ts).alias(ts))
    return rows.join(days, ["native_sensor_id", ts]).select(df.columns)


def correlation_rows(df: DataFrame, start, metrics, required) -> DataFrame:
    """Daily metric matrix per sensor where the required metrics are present."""
    days = active_or_unknown(since(df, start)).withColumn("date", F.to_date("day_ts"))
    out = metric_matrix(days, ["date", "native_sensor_id"], metrics)
    for m in required:
        out = out.filter(F.col(m).isNotNull())
    return out


def extreme_events(df: DataFrame, start, temperature: str = "temperature", pm25: str = "pm2_5") -> DataFrame:
    """Heat, frost, damp, unhealthy air and strong UV."""
    rules = [(temperature, "max_value", ">=", 35.0), (temperature, "min_value", "<=", 0.0),
             ("humidity", "avg_value", ">=", 90.0), (pm25, "avg_value", ">=", 55.0), ("uv_high", "max_value", ">=", 8.0)]
    names = ["Extreme Heat", "Freezing", "Very Humid", "Unhealthy Air", "Very High UV"]
    kind = None
    for (metric, col, op, bound), name in zip(rules, names):
        cond = (F.col("metric_name") == metric) & (F.col(col) >= bound if op == ">=" else F.col(col) <= bound)
        kind = F.when(cond, name) if kind is None else kind.when(cond, name)
    return any_bound(active_or_unknown(since(df, start)), rules).select(
        _day(), "native_sensor_id", "metric_name", "avg_value", "min_value", "max_value", kind.alias("event_type"))


def spatial_grid(df: DataFrame, start, digits: int = 2, temperature: str = "temperature", pm25: str = "pm2_5") -> DataFrame:
    """Sensors and averages per rounded grid cell."""
    pick = lambda m: F.avg(F.when(F.col("metric_name") == m, F.col("avg_value")))
    return active_or_unknown(since(df, start)).groupBy(
        F.round("latitude", digits).alias("lat_cluster"), F.round("longitude", digits).alias("lng_cluster")).agg(
        F.count_distinct("native_sensor_id").alias("sensors_in_area"),
        pick(temperature).alias("avg_temperature"), pick(pm25).alias("avg_pm25"))


def pivot_totals(df: DataFrame, row: str, metrics, value: str = "avg_value") -> DataFrame:
    """Average per row and metric, with a total column and a total row (named ``TOTAL``)."""
    cells = [F.avg(F.when(F.col("metric_name") == m, F.col(value))).alias(m) for m in metrics]
    return (df.rollup(row).agg(*cells, F.avg(value).alias("total"), F.grouping(row).alias("is_total"))
            .withColumn(row, F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col(row))).drop("is_total"))


def availability(df: DataFrame, metric: str, start, end, wide: bool = False) -> DataFrame:
    """Daily rows per sensor and day of one metric; ``wide`` gives one column per day of the range."""
    rows = df.filter(days_between(df, "day_ts", start, end) & (F.col("metric_name") == metric))
    if not wide:
        return rows.groupBy("native_sensor_id", _day()).agg(F.count(F.lit(1)).alias("readings"))
    first, last = as_date(start), as_date(end)
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    return rows.groupBy("native_sensor_id").agg(*[
        F.count_if(F.to_date("day_ts") == F.lit(d)).alias(d.isoformat()) for d in days])


def weekday_pattern(df: DataFrame, start) -> DataFrame:
    """Mean and deviation per day of week (Sunday 1) and metric."""
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    dow = F.dayofweek("day_ts")
    return (active_or_unknown(since(df, start)).groupBy(dow.alias("day_of_week"), "metric_name")
            .agg(F.avg("avg_value").alias("avg_value"), F.stddev_samp("avg_value").alias("std_dev"))
            .withColumn("day_name", F.element_at(F.array(*map(F.lit, names)), F.col("day_of_week"))))


def week_lines(df: DataFrame, metric: str, start) -> DataFrame:
    """Average per week and day of week of one metric."""
    day = F.to_date("day_ts")
    return (active_or_unknown(since(df.filter(F.col("metric_name") == metric), start))
            .groupBy(week_of_year(day).alias("week"), F.dayofweek(day).alias("day_of_week"))
            .agg(F.avg("avg_value").alias("avg_value")))


def metric_stats(df: DataFrame, start) -> DataFrame:
    """Sensors, mean, deviation, extremes and exact median of daily averages per metric."""
    rows = active_or_unknown(since(df, start))
    stats = rows.groupBy("metric_name").agg(
        F.count_distinct("native_sensor_id").alias("sensors"), F.avg("avg_value").alias("mean"),
        F.stddev_samp("avg_value").alias("std_dev"), F.min("min_value").alias("overall_min"),
        F.max("max_value").alias("overall_max"))
    return stats.join(exact_quantile(rows, ["metric_name"], "avg_value", 0.5, "median"), "metric_name", "left")


def scorecards(df: DataFrame, as_of, temperature: str = "temperature", pm25: str = "pm2_5") -> DataFrame:
    """Active sensors and coverage over a week, latest averages and those of the day before.

    The latest day is the one before ``as_of``.
    """
    as_of = as_date(as_of)
    rows = active_or_unknown(since(df, as_of - dt.timedelta(days=7)))
    day = lambda back: F.to_date("day_ts") == F.lit(as_of - dt.timedelta(days=back))
    pick = lambda m, back: F.avg(F.when((F.col("metric_name") == m) & day(back), F.col("avg_value")))
    sensors, metrics = F.count_distinct("native_sensor_id"), F.count_distinct("metric_name")
    return rows.agg(
        sensors.alias("active_sensors"), pick(temperature, 1).alias("latest_temperature"),
        pick(temperature, 2).alias("previous_temperature"), pick(pm25, 1).alias("latest_pm25"),
        pick(pm25, 2).alias("previous_pm25"),
        F.try_divide(F.count(F.lit(1)) * 100.0, sensors * metrics).alias("coverage_pct"))


def sensor_counts(df: DataFrame, start) -> DataFrame:
    """Reporting sensors per day and metric."""
    return active_or_unknown(since(df, start)).groupBy(_day(), "metric_name").agg(
        F.count_distinct("native_sensor_id").alias("sensors"))


def reading_table(df: DataFrame, start, end) -> DataFrame:
    """Averages, extremes and samples per sensor and metric over the days ``start``..``end``."""
    rows = active_or_unknown(df.filter(days_between(df, "day_ts", start, end)))
    return rows.groupBy("native_sensor_id", "metric_name").agg(
        F.avg("avg_value").alias("avg_value"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"), F.sum("samples").alias("samples"))


def metric_range(df: DataFrame, metric: str, start) -> DataFrame:
    """Range of one metric per sensor; its average alone is the bar chart of that metric."""
    rows = active_or_unknown(since(df.filter(F.col("metric_name") == metric), start))
    return rows.groupBy("native_sensor_id").agg(
        F.min("min_value").alias("min_value"), F.avg("avg_value").alias("avg_value"),
        F.max("max_value").alias("max_value"), F.count(F.lit(1)).alias("readings"))


def sample_counts(df: DataFrame, metric: str, start) -> DataFrame:
    """Mean samples per day and sensor of one metric."""
    rows = active_or_unknown(since(df.filter(F.col("metric_name") == metric), start))
    return rows.groupBy(_day(), "native_sensor_id").agg(F.avg("samples").alias("avg_samples"))


def metric_scatter(df: DataFrame, start, x: str, y: str) -> DataFrame:
    """Averages of two metrics per sensor, with the number of rows behind them."""
    pick = lambda m: F.avg(F.when(F.col("metric_name") == m, F.col("avg_value")))
    rows = active_or_unknown(since(df, start)).filter(F.col("metric_name").isin(x, y))
    return rows.groupBy("native_sensor_id").agg(pick(x).alias("x"), pick(y).alias("y"), F.count(F.lit(1)).alias("size"))


def source_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("sensor_source", "sensor_category").agg(
        F.count_distinct("native_sensor_id").alias("sensor_count"),
        F.count_distinct("metric_name").alias("metric_count"), F.min("day_ts").alias("earliest_data"),
        F.max("day_ts").alias("latest_data"), F.sum("samples").alias("total_samples"))
