"""Alert detection, cooldown, resolution and anomaly checks."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from aeroloom import vocab
from aeroloom.functions.numbers import fixed
from aeroloom.operators.health import alert_recommendations
from aeroloom.operators.sequence import BLOCK_ROWS, lookback, sequence_rows
from aeroloom.session import materialize

_NO_TEXT = "array<string>"
_RULES = vocab.ALERT_CONFIG["alert_rules"]


def _alert(prefix: str, kind: str, level: Column, ts: str, metric: str, value: Column, threshold: Column,
           message: Column, missing: Column, recommendations: Column) -> Column:
    at = F.col(ts)
    return F.when(level.isNotNull(), F.struct(
        F.concat(F.lit(prefix + "_"), F.date_format(at, "yyyyMMdd_HHmmss")).alias("id"), F.lit(kind).alias("type"),
        level.alias("level"), at.alias("timestamp"), F.lit(metric).alias("metric"), value.cast("double").alias("value"),
        threshold.cast("double").alias("threshold"), message.alias("message"), missing.alias("missing_metrics"),
        recommendations.alias("recommendations"), F.lit("active").alias("status")))


def _steps(value: Column, steps):
    """(level, threshold, message) columns of the first matching (condition, level, threshold, text before, after)."""
    level = threshold = message = None
    for cond, name, bound, before, after in steps:
        said = F.concat(F.lit(before), fixed(value, 1), F.lit(after))
        level = F.when(cond, name) if level is None else level.when(cond, name)
        threshold = F.when(cond, F.lit(bound)) if threshold is None else threshold.when(cond, F.lit(bound))
        message = F.when(cond, said) if message is None else message.when(cond, said)
    return level, threshold, message


def _threshold_structs(ts: str, config) -> list[Column]:
    limits = config["alert_thresholds"]
    pm, temp, rh = limits["pm25"], limits["temperature"], limits["humidity"]
    none = F.lit(None).cast(_NO_TEXT)
    out = []
    v = F.col("pm25")
    level, bound, said = _steps(v, [
        (v >= pm["critical"], "critical", pm["critical"], "CRITICAL: PM2.5 level extremely high at ", " μg/m³"),
        (v >= pm["high"], "high", pm["high"], "HIGH: PM2.5 level unhealthy at ", " μg/m³"),
        (v >= pm["moderate"], "medium", pm["moderate"], "MODERATE: PM2.5 level elevated at ", " μg/m³")])
    out.append(_alert("pm25", "air_quality", level, ts, "pm25", v, bound, said, none, alert_recommendations("pm25", v)))
    v = F.col("temperature")
    level, bound, said = _steps(v, [
        (v >= temp["extreme_high"], "high", temp["extreme_high"], "EXTREME HEAT: Temperature ", "°C exceeds safe limits"),
        (v <= temp["extreme_low"], "high", temp["extreme_low"], "EXTREME COLD: Temperature ", "°C below safe limits")])
    out.append(_alert("temp", "temperature", level, ts, "temperature", v, bound, said, none,
                      alert_recommendations("temperature", v)))
    v = F.col("humidity")
    level, bound, said = _steps(v, [
        (v >= rh["extreme_high"], "medium", rh["extreme_high"], "EXTREME HUMIDITY: Humidity ", "% extremely high"),
        (v <= rh["extreme_low"], "medium", rh["extreme_low"], "EXTREME DRYNESS: Humidity ", "% extremely low")])
    out.append(_alert("humidity", "humidity", level, ts, "humidity", v, bound, said, none,
                      alert_recommendations("humidity", v)))
    return out


def _missing_struct(ts: str, critical) -> Column:
    missing = F.filter(F.array(*[F.when(F.col(m).isNull(), F.lit(m)) for m in critical]), lambda x: x.isNotNull())
    level = F.when(F.size(missing) > 0, "medium")
    said = F.concat(F.lit("DATA MISSING: Critical metrics unavailable: "), F.concat_ws(", ", missing))
    null = F.lit(None).cast("double")
    return _alert("data_missing", "data_quality", level, ts, "data_completeness", null, null, said, missing,
                  alert_recommendations("data_completeness", null))


def _explode(df: DataFrame, structs, keep) -> DataFrame:
    found = F.filter(F.array(*structs), lambda a: a.isNotNull())
    return df.select(*keep, F.inline(found))


def threshold_alerts(df: DataFrame, config=vocab.ALERT_CONFIG, ts: str = "timestamp", keep=("native_sensor_id",)) -> DataFrame:
    """Alerts for PM2.5, temperature and humidity readings (columns pm25, temperature, humidity)."""
    return _explode(df, _threshold_structs(ts, config), list(keep))


def missing_metric_alerts(df: DataFrame, critical=vocab.CRITICAL_METRICS, ts: str = "timestamp",
                          keep=("native_sensor_id",)) -> DataFrame:
    """One alert per reading that lacks a critical metric."""
    return _explode(df, [_missing_struct(ts, critical)], list(keep))


def reading_alerts(df: DataFrame, config=vocab.ALERT_CONFIG, critical=vocab.CRITICAL_METRICS, ts: str = "timestamp",
                   keep=("native_sensor_id",)) -> DataFrame:
    """Threshold and missing-data alerts in one pass over the readings."""
    return _explode(df, [*_threshold_structs(ts, config), _missing_struct(ts, critical)], list(keep))


# --- cooldown -------------------------------------------------------------------------------------------
# Whether an alert is kept depends on the last kept one, so it is a fold over time.  To keep a hot alert type
# out of a single task the fold is split by time: a chunk's effect on the state "time of the last kept alert"
# is a step function, computed per chunk; the step functions are folded per key (a few rows per chunk); then
# each chunk is walked from its now known state.  Only distinct times take part, so copies collapse first.


def _orbit_ends(times: np.ndarray, entries: np.ndarray, wait: int) -> np.ndarray:
    """Last kept time when each entry index is kept and the fold runs to the end of ``times``."""
    at, back = np.unique(entries, return_inverse=True)
    while True:
        following = np.searchsorted(times, times[at] + wait, side="left")
        moved = np.where(following < len(times), following, at)
        if np.array_equal(moved, at):
            return times[at][back]
        at, again = np.unique(moved, return_inverse=True)
        back = again[back]


def chunk_steps(times: np.ndarray, chunk_start: int, wait: int) -> tuple[np.ndarray, np.ndarray]:
    """Step function of a chunk: first row with ``upper >= earliest allowed time`` gives the last kept time."""
    last = min(int(np.searchsorted(times, chunk_start + wait, side="left")), len(times) - 1)
    entries = np.arange(last + 1)
    ends = _orbit_ends(times, entries, wait)
    run_end = np.append(ends[1:] != ends[:-1], True)
    return times[: last + 1][run_end], ends[run_end]


def _runs(pdf: pd.DataFrame, by) -> list[tuple[int, int]]:
    """(start, stop) of equal neighbouring keys; nulls are equal."""
    changed = np.zeros(max(len(pdf) - 1, 0), dtype=bool)
    for k in by:
        v, gone = pdf[k].to_numpy(), pdf[k].isna().to_numpy()
        changed |= (v[1:] != v[:-1]) & ~(gone[1:] & gone[:-1])
    edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(pdf)]
    return list(zip(edges[:-1], edges[1:])) if len(pdf) else []


def _key(pdf: pd.DataFrame, by, row: int) -> tuple:
    return tuple(None if pd.isna(v) else v for v in (pdf[k].iat[row] for k in by))


def _frame(rows, columns) -> pd.DataFrame:
    return pd.DataFrame({c: [r[i] for r in rows] for i, c in enumerate(columns)}, columns=list(columns))


def _steps_part(keys, chunk_len: int, wait: int):
    by, columns = [*keys, "chunk"], [*keys, "chunk", "upper", "ends"]

    def close(key, parts):
        upper, ends = chunk_steps(np.concatenate(parts), int(key[-1]) * chunk_len, wait)
        return [(*key, int(u), int(e)) for u, e in zip(upper, ends)]

    def run(batches):
        held, parts = None, []
        for pdf in batches:
            rows, t = [], pdf["t"].to_numpy()
            for start, stop in _runs(pdf, by):
                key = _key(pdf, by, start)
                if parts and key != held:
                    rows += close(held, parts)
                    parts = []
                held = key
                parts.append(t[start:stop])
            if rows:
                yield _frame(rows, columns)
        if parts:
            yield _frame(close(held, parts), columns)

    return run


def _entries_part(keys, wait: int):
    """State on entry of each chunk; steps arrive by (key, chunk, upper), so only the state is held."""
    by, columns = [*keys, "chunk"], [*keys, "chunk", "last_kept"]

    def run(batches):
        held, last, settled = None, 0, False
        for pdf in batches:
            rows, upper, ends = [], pdf["upper"].to_numpy(), pdf["ends"].to_numpy()
            for start, stop in _runs(pdf, by):
                key = _key(pdf, by, start)
                if held is None or key[:-1] != held[:-1]:
                    last = int(pdf["last_kept"].iat[start])
                if key != held:
                    rows.append((*key, last))
                    settled, held = False, key
                if not settled:
                    i = start + int(np.searchsorted(upper[start:stop], last + wait, side="left"))
                    if i < stop:
                        last, settled = int(ends[i]), True
            if rows:
                yield _frame(rows, columns)

    return run


def _walk_part(keys, wait: int):
    """Kept times of each chunk; times arrive in order, so only the last kept one is held."""
    by, columns = [*keys, "chunk"], [*keys, "kept_at"]

    def run(batches):
        held, last = None, 0
        for pdf in batches:
            rows, t = [], pdf["t"].to_numpy()
            for start, stop in _runs(pdf, by):
                key = _key(pdf, by, start)
                if key != held:
                    held, last = key, int(pdf["last_kept"].iat[start])
                i = start + int(np.searchsorted(t[start:stop], last + wait, side="left"))
                while i < stop:
                    last = int(t[i])
                    rows.append((*key[:-1], last))
                    i = start + int(np.searchsorted(t[start:stop], last + wait, side="left"))
            if rows:
                yield _frame(rows, columns)

    return run


def _matching(df: DataFrame, small: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on keys that may be null, keeping one copy of them."""
    other = small.withColumnsRenamed({k: f"{k}__k" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(other[f"{k}__k"])
    return df.join(other, same, how).drop(*[f"{k}__k" for k in keys])


def apply_cooldown(alerts: DataFrame, minutes: int = _RULES["cooldown_minutes"], keys=("type",), ts: str = "timestamp", ties=("id",),
                   state: DataFrame | None = None, chunk_hours: int = 24) -> DataFrame:
    """Alerts that survive the cooldown: an alert is dropped when a kept one of its key is under ``minutes`` old.

    Of several alerts of a key at one time the first by ``ties``, then by all other columns, is kept, so the result
    does not depend on the order of the input.  ``state`` (keys, last_kept in microseconds) carries the last kept times of
    an earlier run.
    """
    keys = list(keys)
    # The alerts are read three times below: planned once.
    alerts = materialize(alerts)
    wait, chunk_len = minutes * 60_000_000, chunk_hours * 3_600_000_000
    if chunk_len < wait:
        raise ValueError("a chunk must be at least as long as the cooldown")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    types = {f.name: f.dataType.simpleString() for f in alerts.schema}
    ddl = ", ".join(f"`{k}` {types[k]}" for k in keys)
    times = (alerts.filter(F.col(ts).isNotNull()).select(*keys, micros.alias("t")).distinct()
             .withColumn("chunk", F.floor(F.col("t") / chunk_len)))

    steps = (times.repartition(*keys, "chunk").sortWithinPartitions(*keys, "chunk", "t")
             .mapInPandas(_steps_part(keys, chunk_len, wait), f"{ddl}, chunk bigint, upper bigint, ends bigint"))
    never = F.lit(-(1 << 62)).cast("bigint")
    if state is None:
        steps = steps.withColumn("last_kept", never)
    else:
        steps = (_matching(steps, state.select(*keys, "last_kept"), keys, "left")
                 .withColumn("last_kept", F.coalesce("last_kept", never)))
    entries = (steps.repartition(*keys).sortWithinPartitions(*keys, "chunk", "upper")
               .mapInPandas(_entries_part(keys, wait), f"{ddl}, chunk bigint, last_kept bigint"))
    kept = (_matching(times, entries, [*keys, "chunk"]).repartition(*keys, "chunk")
            .sortWithinPartitions(*keys, "chunk", "t").mapInPandas(_walk_part(keys, wait), f"{ddl}, kept_at bigint"))

    at = "alert_micros__k"
    hits = _matching(alerts.withColumn(at, micros), kept.withColumnRenamed("kept_at", at), [*keys, at]).drop(at)
    # Copies at one time: Spark keeps one row per key and task before the shuffle.
    rest = [f.name for f in alerts.schema if f.name not in {*keys, ts, *ties} and not isinstance(f.dataType, T.MapType)]
    w = Window.partitionBy(*keys, ts).orderBy(*[F.col(c).asc_nulls_last() for c in [*ties, *rest]] or [F.lit(1)])
    return hits.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def auto_resolve(alerts: DataFrame, now, hours: float = _RULES["auto_resolve_hours"], ts: str = "timestamp") -> DataFrame:
    """Active alerts older than ``hours`` become ``auto_resolved``."""
    cutoff = F.lit(str(now)).cast("timestamp") - F.expr(f"interval {int(hours * 60)} minutes")
    old = (F.col("status") == "active") & (F.col(ts).cast("timestamp") < cutoff)
    return alerts.withColumn("status", F.when(old, "auto_resolved").otherwise(F.col("status")))


def recent_alerts(alerts: DataFrame, now, hours: int = 24, ts: str = "timestamp") -> DataFrame:
    cutoff = F.lit(str(now)).cast("timestamp") - F.expr(f"interval {hours} hours")
    return alerts.filter(F.col(ts).cast("timestamp") > cutoff)


def alert_summary(alerts: DataFrame, now, hours: int = 24, ts: str = "timestamp") -> DataFrame:
    """Counts of the last ``hours``: lines ``total``, ``active``, ``level`` and ``type``."""
    recent = recent_alerts(alerts, now, hours, ts)
    counts = recent.groupBy("level", "type", "status").agg(F.count(F.lit(1)).alias("n"))
    line = lambda df, kind, name: df.select(F.lit(kind).alias("kind"), name.alias("name"), "alerts")
    total = lambda df: df.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("alerts"))
    return (line(total(counts), "total", F.lit(None).cast("string"))
            .unionByName(line(total(counts.filter(F.col("status") == "active")), "active", F.lit(None).cast("string")))
            .unionByName(line(counts.groupBy("level").agg(F.sum("n").alias("alerts")), "level", F.col("level")))
            .unionByName(line(counts.groupBy("type").agg(F.sum("n").alias("alerts")), "type", F.col("type"))))


def recent_critical(alerts: DataFrame, now, hours: int = 24, last: int | None = 10, ts: str = "timestamp", ties=("id",)) -> DataFrame:
    """Critical and high alerts among the last ``last`` of the period, or among all of them."""
    newest = recent_alerts(alerts, now, hours, ts)
    if last is not None:
        newest = newest.orderBy(F.desc(ts), *[F.desc(t) for t in ties]).limit(last)
    return newest.filter(F.col("level").isin("critical", "high"))


# --- statistical checks (own semantics: the configuration names the limits, nothing more) ----------------


def zscore_anomalies(df: DataFrame, limits=vocab.ZSCORE_LIMITS, days: int = vocab.TREND_WINDOW_DAYS,
                     ts: str = "timestamp") -> DataFrame:
    """Long readings further than the metric's limit from the mean of the sensor's ``days`` earlier days.

    The baseline comes from daily sums, so the window runs over one row per sensor, metric and day.
    """
    known = df.filter(F.col("metric_name").isin(list(limits)) & F.col("value").isNotNull())
    day = F.to_date(ts)
    daily = known.groupBy("native_sensor_id", "metric_name", day.alias("day")).agg(
        F.count("value").cast("double").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    w = (Window.partitionBy("native_sensor_id", "metric_name").orderBy(F.datediff("day", F.lit(dt.date(1970, 1, 1))))
         .rangeBetween(-days, -1))
    n, s, ss = F.sum("n").over(w), F.sum("s").over(w), F.sum("ss").over(w)
    base = (daily.select("native_sensor_id", "metric_name", "day", n.alias("n"), s.alias("s"), ss.alias("ss"))
            .filter(F.col("n") > 1)
            .withColumn("baseline_mean", F.col("s") / F.col("n"))
            .withColumn("baseline_sd", F.sqrt(F.greatest(
                (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1), F.lit(0.0))))
            .filter(F.col("baseline_sd") > 0).drop("n", "s", "ss"))
    limit = None
    for m, bound in limits.items():
        limit = F.when(F.col("metric_name") == m, bound) if limit is None else limit.when(F.col("metric_name") == m, bound)
    z = (F.col("value") - F.col("baseline_mean")) / F.col("baseline_sd")
    return (known.withColumn("day", day).join(base, ["native_sensor_id", "metric_name", "day"])
            .withColumn("z_score", z).filter(F.abs("z_score") > limit).drop("day"))


def sensor_health(df: DataFrame, metric: str, now, config=vocab.ALERT_CONFIG, ts: str = "timestamp", ties=(),
                  key: str = "native_sensor_id") -> DataFrame:
    """Per sensor: readings past the limit in a row, longest gap, share of repeated values and outliers.

    ``metric`` is both the configuration entry and the value column.
    """
    limits, dq = config["alert_thresholds"][metric], config["alert_thresholds"]["data_quality"]
    run = limits["consecutive_readings"]
    v = F.col(metric)
    past = v >= limits.get("moderate", limits.get("extreme_high"))
    if "extreme_low" in limits:
        past = past | (v <= limits["extreme_low"])
    rows = sequence_rows(df.filter(v.isNotNull() & F.col(ts).isNotNull()).select(key, ts, metric, *ties)
                         .withColumn("past", past.cast("int")), [key], ts, ties)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    made = {"run": lambda w: F.sum("past").over(w.rowsBetween(-(run - 1), 0)),
            "gap": lambda w: (at - F.lag(at, 1).over(w)) / 3.6e9,
            "repeated": lambda w: (F.col(metric) == F.lag(metric, 1).over(w)).cast("int")}
    seen = lookback(rows, [key], max(run - 1, 1), made)
    stats = df.groupBy(key).agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("sd"), F.count(F.lit(1)).alias("rows"))
    z = F.abs(F.col(metric) - F.col("mean")) / F.nullif(F.col("sd"), F.lit(0.0))
    now = F.unix_micros(F.lit(str(now)).cast("timestamp"))
    # A sensor's rows meet its statistics block by block, and are summed up there first.
    seen = seen.withColumn("at_block", F.floor((F.col("seq") - 1) / BLOCK_ROWS))
    stats = stats.withColumn("at_block", F.explode(F.expr(f"sequence(0L, CAST(floor((rows - 1) / {BLOCK_ROWS}) AS BIGINT))"))).drop("rows")
    parts = seen.join(stats, [key, "at_block"]).groupBy(key, "at_block").agg(
        F.count_if(F.col("run") >= run).alias("runs"), F.max("gap").alias("gap"), F.max(at).alias("at"),
        F.sum(F.coalesce("repeated", F.lit(0))).alias("same"), F.count(F.lit(1)).alias("n"),
        F.count_if(z > vocab.ZSCORE_LIMITS[metric]).alias("far"))
    out = parts.groupBy(key).agg(
        F.sum("runs").alias("consecutive_runs"), F.max("gap").alias("longest_gap_hours"), ((now - F.max("at")) / 3.6e9).alias("silent_hours"),
        (100.0 * F.sum("same") / F.sum("n")).alias("repeated_pct"), F.sum("far").alias("outliers"))
    return out.withColumns({
        "sustained": F.col("consecutive_runs") > 0,
        "missing_data": F.greatest(F.coalesce("longest_gap_hours", F.lit(0.0)), "silent_hours") > dq["missing_data_hours"],
        "stuck": F.col("repeated_pct") > dq["stuck_values_percentage"],
        "noisy": F.col("outliers") > dq["outlier_count_threshold"]})
