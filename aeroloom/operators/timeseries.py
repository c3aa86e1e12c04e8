"""Ordered analyses: lags, moving averages, cadence, splits, trends and decomposition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from aeroloom import vocab
from aeroloom.functions.times import as_date, bin_start, season
from aeroloom.operators.sequence import BLOCK_ROWS, lookback, rank_within, sequence_rows
from aeroloom.session import materialize


def lag_features(df: DataFrame, key: str, ts: str, col: str, lags=vocab.LAGS, ties=(),
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Values 1, 6, 12 and 24 rows back, per sensor."""
    rows = sequence_rows(df, [key], ts, ties)
    made = {f"{col}_lag_{n}h": (lambda w, n=n: F.lag(col, n).over(w)) for n in lags}
    return lookback(rows, [key], max(lags), made, block_rows).drop("seq", "key_rows")


def _mean(col: str, size: int, include_current: bool):
    first, last = (-(size - 1), 0) if include_current else (-size, -1)
    return lambda w: F.avg(col).over(w.rowsBetween(first, last))


def moving_averages(df: DataFrame, key: str, ts: str, col: str, sizes=vocab.MOVING_AVERAGES,
                    include_current: bool = False, ties=(),
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean of up to n rows, per sensor.

    The current row is left out by default, since it is what a forecast predicts.
    """
    rows = sequence_rows(df, [key], ts, ties)
    made = {f"{col}_ma_{n}h": _mean(col, n, include_current) for n in sizes}
    return lookback(rows, [key], max(sizes), made, block_rows).drop("seq", "key_rows")


def history_features(df: DataFrame, key: str, ts: str, col: str, include_current: bool = False, ties=(),
                     lags=vocab.LAGS, sizes=vocab.MOVING_AVERAGES) -> DataFrame:
    """Lags and moving averages over one ordering of the rows."""
    rows = sequence_rows(df, [key], ts, ties)
    made = {f"{col}_lag_{n}h": (lambda w, n=n: F.lag(col, n).over(w)) for n in lags}
    made |= {f"{col}_ma_{n}h": _mean(col, n, include_current) for n in sizes}
    return lookback(rows, [key], max(*lags, *sizes), made).drop("seq", "key_rows")


def cadence(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Per key: first and last time and the inferred step in seconds (900 or 3600).

    The step is 15 minutes when the median gap is at most 20 minutes.  Whether the median is at most a
    bound follows from counts on both sides of it, so no gap list is gathered.  Gaps are taken within each day of a
    key and between neighbouring days.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    times = df.filter(F.col(ts).isNotNull()).select(key, ts, at.alias("at"), F.floor(at / 86_400_000_000).alias("at_day"))
    inside = Window.partitionBy(key, "at_day").orderBy("at")
    rows = times.withColumn("gap", (F.col("at") - F.lag("at", 1).over(inside)) / 1e6)
    limit = 1200.0

    def counted(gap: Column) -> dict[str, Column]:
        return {"gaps": F.count(gap), "short": F.count_if(gap <= limit), "below": F.max(F.when(gap <= limit, gap)),
                "above": F.min(F.when(gap > limit, gap))}

    # The rows already lie by (key, day); what is left is a row per day, and the gap from the day before.
    days = rows.groupBy(key, "at_day").agg(F.min(ts).alias("time_min"), F.max(ts).alias("time_max"), F.min("at").alias("at_min"), F.max("at").alias("at_max"),
                                           *[c.alias(name) for name, c in counted(F.col("gap")).items()])
    across = Window.partitionBy(key).orderBy("at_day")
    days = days.withColumn("gap", (F.col("at_min") - F.lag("at_max", 1).over(across)) / 1e6)
    border = counted(F.col("gap"))
    stats = days.groupBy(key).agg(
        F.min("time_min").alias("time_min"), F.max("time_max").alias("time_max"), (F.sum("gaps") + border["gaps"]).alias("gaps"),
        (F.sum("short") + border["short"]).alias("short"), F.greatest(F.max("below"), border["below"]).alias("below"),
        F.least(F.min("above"), border["above"]).alias("above"))
    # More than half short: short median.  Exactly half: the median is the mean of the two middle gaps.
    is_short = (F.col("short") * 2 > F.col("gaps")) | (
        (F.col("short") * 2 == F.col("gaps")) & ((F.col("below") + F.col("above")) / 2 <= limit))
    return stats.select(key, "time_min", "time_max",
                        F.when(F.col("gaps") > 0, F.when(is_short, 900).otherwise(3600)).alias("step_seconds"))


def cadence_gaps(df: DataFrame, key: str, ts: str, first: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(summary, missing slots): expected slots per key at its inferred step, and those without a reading.

    All missing slots are listed; ``first=25`` keeps the first per key, as a printed report does.  The summary counts all.
    """
    # One small row per key, fixed: what follows reads it three times.
    steps = materialize(cadence(df, key, ts).filter(F.col("step_seconds").isNotNull()))
    step = F.col("step_seconds")
    low = F.floor(F.unix_seconds(F.col("time_min").cast("timestamp")) / step)
    high = F.ceil(F.unix_micros(F.col("time_max").cast("timestamp")) / 1e6 / step)
    spans = steps.select(key, "step_seconds", low.cast("bigint").alias("low"), high.cast("bigint").alias("high"))
    # A day's slots at a time, so that no record holds a key's whole timeline.
    slots = (spans.withColumn("from", F.explode(F.expr("sequence(low, high, 96L)")))
             .select(key, "step_seconds", F.explode(F.sequence("from", F.least(F.col("from") + 95, F.col("high")))).alias("slot")))
    # One row per occupied quarter hour, reduced map-side before anything is shuffled; an hour is four of them.
    quarters = (df.filter(F.col(ts).isNotNull()).select(key, F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 900).alias("quarter")).distinct())
    seen = (quarters.join(steps.select(key, "step_seconds"), key)
            .select(key, F.floor(F.col("quarter") * 900 / step).alias("slot")).distinct())
    missing = slots.join(seen, [key, "slot"], "left_anti").select(
        key, F.timestamp_seconds(F.col("slot") * step).alias("missing_slot"))
    summary = (spans.join(missing.groupBy(key).agg(F.count(F.lit(1)).alias("missing_count")), key, "left")
               .select(key, F.when(step == 900, "15min").otherwise("1h").alias("inferred_freq"),
                       (F.col("high") - F.col("low") + 1).alias("expected_rows"),
                       F.coalesce("missing_count", F.lit(0)).cast("bigint").alias("missing_count")))
    if first is not None:
        w = Window.partitionBy(key).orderBy("missing_slot")
        missing = missing.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= first).drop("rn")
    return summary, missing


def chrono_split(df: DataFrame, ts: str, frac: float = 0.8, key: str | None = None, ties=()) -> DataFrame:
    """Add ``split``: the first ``frac`` of the rows in time order train, the rest test.

    Over the whole table by default, or per key.  Rows without a time are kept and belong to neither.
    """
    # One key for all rows, computed from the data: a literal would turn the key joins into nested loops.
    keyed = df.withColumn("split_key", F.pmod(F.hash(ts), F.lit(1))) if key is None else df
    k = key or "split_key"
    out = sequence_rows(keyed, [k], ts, ties).withColumn(
        "split", F.when(F.col("seq") <= F.floor(F.col("key_rows") * frac), "train").when(F.col("seq").isNotNull(), "test"))
    return out.drop("seq", "key_rows", *([] if key else ["split_key"]))


def last_n(df: DataFrame, ts: str, n: int, key: str | None = None, ties=()) -> DataFrame:
    """Last ``n`` rows by time, of the table or per key; both keep only n rows per task before the shuffle."""
    order = [F.desc(ts), *[F.desc(t) for t in ties]]
    if key is None:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")


latest_n = last_n


def head_tail(df: DataFrame, ts: str, n: int, key: str | None = None, ties=()) -> DataFrame:
    """First ``n`` rows (``part='head'``) and last ``n`` rows (``part='tail'``)."""
    if key is None:
        head = df.orderBy(ts, *ties).limit(n)
    else:
        w = Window.partitionBy(key).orderBy(ts, *ties)
        head = df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")
    return (head.withColumn("part", F.lit("head"))
            .unionByName(last_n(df, ts, n, key, ties).withColumn("part", F.lit("tail"))))


def order_by(df: DataFrame, *cols) -> DataFrame:
    """Multi-key sort; Spark range-partitions it, so no task holds the whole result."""
    return df.orderBy(*cols)


def daily_means(df: DataFrame, ts: str, value: str, key: str | None = None) -> DataFrame:
    """Mean per day (and key): the series the seasonal analysis runs on, one row per day."""
    by = [key] if key else []
    return (df.filter(F.col(value).isNotNull() & F.col(ts).isNotNull())
            .groupBy(*by, F.to_date(ts).alias("day")).agg(F.avg(value).alias("value")))


def _five(value: str):
    return [F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
            F.max(value).alias("max"), F.count(value).alias("count")]


def calendar_stats(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Monthly and seasonal statistics of daily means."""
    daily = daily_means(df, ts, value).withColumn("month", F.month("day"))
    monthly = daily.groupBy(F.col("month").cast("string").alias("period")).agg(*_five("value"))
    seasonal = daily.groupBy(season(F.col("month")).alias("period")).agg(*_five("value"))
    return (monthly.select(F.lit("month").alias("kind"), "*")
            .unionByName(seasonal.select(F.lit("season").alias("kind"), "*")))


def high_days(daily: DataFrame, q: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(summary, by month) of days above the ``q`` quantile; ``daily`` has one row per calendar day."""
    # percentile over days: its input is bounded by the calendar, not by the readings.
    threshold = daily.agg(F.percentile("value", F.lit(q))).scalar()
    flagged = daily.withColumn("threshold", threshold)
    high = F.col("value") > F.col("threshold")
    summary = flagged.agg(
        F.max("threshold").alias("threshold"), F.count_if(high).alias("total_high_days"),
        (100.0 * F.count_if(high) / F.count(F.lit(1))).alias("percentage_high_days"))
    by_month = (flagged.filter(high).groupBy(F.month("day").alias("month"))
                .agg(F.count(F.lit(1)).alias("high_days")))
    return summary, by_month


def overall_stats(daily: DataFrame) -> DataFrame:
    n = F.count("value")
    return daily.agg(
        F.avg("value").alias("mean_pm25"), F.percentile("value", F.lit(0.5)).alias("median_pm25"),
        F.stddev_samp("value").alias("std_pm25"), F.min("value").alias("min_pm25"), F.max("value").alias("max_pm25"),
        F.when(n > 30, "good").otherwise("limited").alias("data_quality"))


def trend_change(daily: DataFrame, n: int = 7, band: float = 2) -> DataFrame:
    """Average of the last ``n`` days against the first ``n``; needs at least ``n`` days."""
    parts = head_tail(daily, "day", n)
    mean = lambda part: F.avg(F.when(F.col("part") == part, F.col("value")))
    out = parts.agg(mean("tail").alias("recent_average"), mean("head").alias("older_average"),
                    F.count_if(F.col("part") == "head").alias("days"))
    change = F.col("recent_average") - F.col("older_average")
    return out.filter(F.col("days") >= n).select(
        "recent_average", "older_average", change.alias("trend_change"),
        F.when(change < -band, "improving").when(change > band, "worsening").otherwise("stable").alias("trend_direction"))


def decompose_status(daily: DataFrame, key: str, period: int | None = None, min_days: int = 30) -> DataFrame:
    """Per key: days, the period `decompose` takes and whether it gives rows (``ok``, ``too short`` or ``no period``)."""
    sized = daily.groupBy(key).agg(F.count(F.lit(1)).alias("days"))
    p = F.lit(period) if period else F.least(F.lit(30), F.floor(F.col("days") / 4)).cast("int")
    status = (F.when(F.col("days") < min_days, "too short").when((F.col("period") < 7) | (F.col("period") * 2 > F.col("days")), "no period")
              .otherwise("ok"))
    return sized.withColumn("period", p).withColumn("status", status)


def decompose(daily: DataFrame, key: str, period: int | None = None, min_days: int = 30) -> DataFrame:
    """Additive decomposition of each key's daily series: ``trend``, ``seasonal`` and ``resid`` per day.

    The trend is a centred moving average (even periods weigh the two ends by half), extended at both ends
    by a line fitted to its first and last ``period - 1`` points.  ``period`` defaults to a quarter of the
    series, at most 30; series shorter than ``min_days``, or with a period under 7, give no rows
    (`decompose_status` names them).

    Series are addressed by day position; a key's series has one row per day and is never gathered into one record.
    """
    w = Window.partitionBy(key).orderBy("day")
    sized = (daily.withColumn("i", F.row_number().over(w) - 1)
             .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(key)))
             .withColumn("p", F.lit(period) if period else F.least(F.lit(30), F.floor(F.col("n") / 4)).cast("int"))
             .filter((F.col("n") >= min_days) & (F.col("p") >= 7) & (F.col("p") * 2 <= F.col("n"))))
    half = F.floor(F.col("p") / 2).cast("int")
    even = F.col("p") % 2 == 0
    # Sums of a window are differences of running sums, looked up at its two ends.
    running = sized.withColumn("running", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    low = running.select(key, (F.col("i") + half).alias("i"), (F.col("running") - F.col("value")).alias("before"), F.col("value").alias("low_value"))
    high = running.select(key, (F.col("i") - half).alias("i"), F.col("running").alias("upto"), F.col("value").alias("high_value"))
    ends = F.when(even, (F.col("low_value") + F.col("high_value")) / 2).otherwise(0.0)
    inner = low.join(high, [key, "i"]).join(sized.select(key, "i", "p"), [key, "i"]).select(
        key, "i", ((F.col("upto") - F.col("before") - ends) / F.col("p")).alias("inner"))
    with_trend = sized.join(inner, [key, "i"], "left")
    # End fits: the first p-1 inner points, and the p-1 points before the last inner one.
    first, last = half, F.col("n") - 1 - half
    stop = F.least(first + F.col("p") - 1, last)
    start = F.greatest(first, last - F.col("p") + 1)
    x = F.col("i").cast("double")
    y_head = F.when((F.col("i") >= first) & (F.col("i") < stop), F.col("inner"))
    y_tail = F.when((F.col("i") >= start) & (F.col("i") < last), F.col("inner"))
    fits = with_trend.groupBy(key).agg(
        F.regr_slope(y_head, x).alias("hs"), F.regr_intercept(y_head, x).alias("hi"),
        F.regr_slope(y_tail, x).alias("ts"), F.regr_intercept(y_tail, x).alias("ti"))
    trend = (F.when(F.col("i") < first, F.col("hs") * x + F.col("hi"))
             .when(F.col("i") > last, F.col("ts") * x + F.col("ti")).otherwise(F.col("inner")))
    detrended = (with_trend.join(fits, key).withColumn("trend", trend)
                 .withColumn("phase", (F.col("i") % F.col("p")).cast("int"))
                 .withColumn("d", F.col("value") - F.col("trend")))
    phases = detrended.groupBy(key, "phase").agg(F.avg("d").alias("phase_mean"))
    centred = phases.join(phases.groupBy(key).agg(F.avg("phase_mean").alias("grand")), key).select(
        key, "phase", (F.col("phase_mean") - F.col("grand")).alias("seasonal"))
    return detrended.join(centred, [key, "phase"]).select(
        key, "day", "value", F.col("p").alias("period"), "trend", "seasonal",
        (F.col("d") - F.col("seasonal")).alias("resid"))


def trend_slope(decomposed: DataFrame, key: str) -> DataFrame:
    """Trend change per day with its direction, and the seasonal amplitude, per key."""
    slope = (F.max_by("trend", "day") - F.min_by("trend", "day")) / F.count(F.lit(1))
    return decomposed.groupBy(key).agg(
        slope.alias("trend_slope"), (F.max("seasonal") - F.min("seasonal")).alias("seasonal_amplitude"),
        F.max("period").alias("period_used")).withColumn(
        "trend_direction", F.when(F.col("trend_slope") > 0.1, "increasing")
        .when(F.col("trend_slope") < -0.1, "decreasing").otherwise("stable"))


def rank_by_metric(df: DataFrame, start, ts: str = "day_ts", digits: int | None = None) -> DataFrame:
    """Sensors ranked per metric by their average since ``start``.

    ``digits`` rounds the averages first, so that equal ones tie whatever order they were summed in.
    """
    mean = F.avg("avg_value") if digits is None else F.round(F.avg("avg_value"), digits)
    avg = (df.filter(F.col(ts) >= F.lit(as_date(start).isoformat()).cast(df.schema[ts].dataType))
           .groupBy("native_sensor_id", "metric_name").agg(mean.alias("avg_value")))
    return rank_within(avg, ["metric_name"], "avg_value", "sensor_rank")


def week_over_week(df: DataFrame, as_of, ts: str = "day_ts") -> DataFrame:
    """Average of the last seven days against the seven before, per sensor and metric."""
    kind = df.schema[ts].dataType
    week = F.lit((as_date(as_of) - dt.timedelta(days=7)).isoformat()).cast(kind)
    two = F.lit((as_date(as_of) - dt.timedelta(days=14)).isoformat()).cast(kind)
    out = (df.filter(F.col(ts) >= two).groupBy("native_sensor_id", "metric_name").agg(
        F.avg(F.when(F.col(ts) >= week, F.col("avg_value"))).alias("current_avg"),
        F.avg(F.when(F.col(ts) < week, F.col("avg_value"))).alias("previous_avg")))
    diff = F.col("current_avg") - F.col("previous_avg")

    def shown(col: Column, digits: int) -> Column:
        # Float noise is rounded off first, so that 17.025 is a tie however it was computed.
        return F.round(F.round(col, 8), digits)

    return (out.filter(F.col("current_avg").isNotNull() & F.col("previous_avg").isNotNull())
            .withColumns({"change": shown(diff, 2),
                          "percent_change": shown(F.try_divide(diff, F.col("previous_avg")) * 100, 1)}))
