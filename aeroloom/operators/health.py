"""Health impact: category shares, exposure, advisories and recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from aeroloom import vocab
from aeroloom.functions import air
from aeroloom.functions.numbers import exact_round, fixed
from aeroloom.operators.timeseries import last_n


def category_distribution(df: DataFrame, value: str = "pm25") -> DataFrame:
    """Count and percentage per health category, the most frequent marked predominant."""
    counts = (df.filter(F.col(value).isNotNull()).groupBy(air.health_category(F.col(value)).alias("category"))
              .agg(F.count(F.lit(1)).alias("count")))
    # At most six rows from here on.
    everything = Window.partitionBy()
    by_count = Window.orderBy(F.desc("count"), "category")
    return counts.withColumns({
        "percentage": exact_round(F.col("count") / F.sum("count").over(everything) * 100, 1),
        "predominant": F.row_number().over(by_count) == 1})


def exposure_hours(df: DataFrame, value: str = "pm25") -> DataFrame:
    """Readings per exposure class."""
    v = F.col(value)
    return df.agg(
        F.count_if(v <= 12).alias("good_air_hours"), F.count_if((v > 12) & (v <= 35.5)).alias("moderate_air_hours"),
        F.count_if((v > 35.5) & (v <= 55.5)).alias("unhealthy_sensitive_hours"),
        F.count_if((v > 55.5) & (v <= 150.5)).alias("unhealthy_hours"),
        F.count_if(v > 150.5).alias("very_unhealthy_hours"), F.count(F.lit(1)).alias("total_hours"))


def advisory_level(hours: DataFrame) -> DataFrame:
    """Add ``health_advisory_level`` to exposure hours."""
    return hours.withColumn("health_advisory_level",
        F.when(F.col("very_unhealthy_hours") > 0, "HEALTH_EMERGENCY")
        .when(F.col("unhealthy_hours") > F.col("total_hours") * 0.1, "HEALTH_WARNING")
        .when(F.col("unhealthy_sensitive_hours") > F.col("total_hours") * 0.2, "HEALTH_ADVISORY")
        .otherwise("NORMAL"))


def population_impact(hours: DataFrame, population: int = vocab.POPULATION, share: float = vocab.SENSITIVE_SHARE) -> DataFrame:
    sensitive = F.lit(int(population * share)).cast("bigint")
    everyone, none = F.lit(population).cast("bigint"), F.lit(0).cast("bigint")
    return hours.withColumns({
        "total_population": everyone, "sensitive_population": sensitive,
        "at_risk_during_moderate": F.when(F.col("moderate_air_hours") > 0, sensitive).otherwise(none),
        "at_risk_during_unhealthy": F.when(F.col("unhealthy_hours") > 0, everyone).otherwise(none)})


def _texts(texts) -> Column:
    return F.array(*[F.lit(t) for t in texts])


def health_recommendations(level: Column) -> Column:
    """Recommendations for an average PM2.5 level, with the general ones."""
    out = None
    for bound, _, texts in vocab.HEALTH_RECOMMENDATIONS:
        cond = level.isNotNull() if bound is None else level > bound
        out = F.when(cond, _texts(texts)) if out is None else out.when(cond, _texts(texts))
    return F.concat(out, _texts(vocab.GENERAL_RECOMMENDATIONS))


def alert_recommendations(metric: str, value: Column) -> Column:
    """Recommendations for one alert metric at a value; the first matching bound wins."""
    out = None
    for op, bound, texts in vocab.ALERT_RECOMMENDATIONS[metric]:
        cond = F.lit(True) if op is None else (value >= bound if op == ">=" else value <= bound)
        out = F.when(cond, _texts(texts)) if out is None else out.when(cond, _texts(texts))
    return out


def with_recommendations(df: DataFrame, level: str, table: DataFrame | None = None) -> DataFrame:
    """Add ``recommendations`` for the PM2.5 level in ``level``.

    A custom ``table`` of (level_name, recommendations) is joined on the level name instead.
    """
    if table is None:
        return df.withColumn("recommendations", health_recommendations(F.col(level)))
    return df.join(table.withColumnRenamed("level_name", level), level, "left")


def health_report(df: DataFrame, ts: str = "timestamp", value: str = "pm25", last: int | None = None, ties=(), hours: float | None = 168,
                  population: int = vocab.POPULATION, share: float = vocab.SENSITIVE_SHARE) -> DataFrame:
    """One-row report: period, summary, distribution, exposure and advice.

    Covers the ``hours`` up to the latest reading, however many sensors there are (None: all); ``last=168`` takes that many
    readings instead, which is a week of hours for one sensor.
    """
    recent = df.select(ts, value, *ties)
    if last is not None:
        recent = last_n(recent, ts, last, ties=ties)
    elif hours is not None:
        at = F.unix_micros(F.col(ts).cast("timestamp"))
        recent = recent.filter(at > recent.agg(F.max(at)).scalar() - int(hours * 3_600_000_000))
    exposure = population_impact(advisory_level(exposure_hours(recent, value)), population, share)
    shares = category_distribution(recent, value)
    summary = recent.agg(
        F.min(ts).alias("period_start"), F.max(ts).alias("period_end"), F.count(F.lit(1)).alias("total_readings"),
        F.avg(value).alias("mean"), F.max(value).alias("top"))
    # Each side is one aggregate row; they are put together as scalars of one row.
    dist = shares.agg(
        F.array_sort(F.collect_list(F.struct("category", "count", "percentage"))).alias("distribution"),
        F.max(F.when(F.col("predominant"), F.col("category"))).alias("predominant_category"))
    base = summary.withColumns({
        "average_pm25": exact_round(F.col("mean"), 1), "maximum_pm25": exact_round(F.col("top"), 1),
        "recommendations": health_recommendations(F.col("mean"))}).drop("mean", "top")
    return base.withColumns({
        "predominant_category": dist.select("predominant_category").scalar(),
        "distribution": dist.select("distribution").scalar(),
        "exposure": exposure.select(F.struct("*")).scalar()})


def forecast_advisory(forecast: DataFrame, hours: int = 24, key: str | None = None) -> DataFrame:
    """Advisory level and message for the next ``hours`` hours of a forecast."""
    by = [key] if key else []
    near = forecast.filter(F.col("hours_ahead") <= hours)
    out = near.groupBy(*by).agg(F.max("predicted_pm25").alias("top"), F.avg("predicted_pm25").alias("mean"))
    top, mean = F.col("top"), F.col("mean")
    steps = [
        (top >= 150, "emergency", "Health Emergency: Extremely high air pollution expected (max ", top),
        (top >= 55, "warning", "Health Warning: Unhealthy air quality expected (max ", top),
        (top >= 35, "advisory", "Health Advisory: Elevated air pollution for sensitive groups (max ", top),
        (mean > 15, "watch", "Air Quality Watch: Monitor conditions (avg ", mean),
        (mean.isNotNull(), "good", "Good Air Quality: Conditions expected to remain healthy (avg ", mean),
    ]
    level = message = None
    for cond, name, text, shown in steps:
        said = F.concat(F.lit(text), fixed(shown, 1), F.lit(" μg/m³)"))
        level = F.when(cond, name) if level is None else level.when(cond, name)
        message = F.when(cond, said) if message is None else message.when(cond, said)
    return out.select(*by, F.coalesce(level, F.lit("unknown")).alias("level"),
                      F.coalesce(message, F.lit("No short-term predictions available")).alias("message"),
                      exact_round(top, 1).alias("max_pm25_24h"), exact_round(mean, 1).alias("avg_pm25_24h"))
