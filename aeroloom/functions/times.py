"""Time columns: epoch units, canonical timestamps, day bounds and calendar features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from aeroloom.vocab import TIME_CANDIDATES

# Epoch magnitude limits, (nanoseconds from, microseconds from, milliseconds from).
# "materialize" and "staging" look at the absolute value; "staging" knows no milliseconds and its
# limits are exclusive.
EPOCH_RULES = {
    "materialize": (10**17, 10**14, 10**11),
    "normalize_day": (10**18, 10**15, 10**12),
    "verify": (10**18, 10**15, 10**12),
    "staging": (9_007_199_254_740_993, 9_007_199_254_741, None),
}
_SIGNED = {"normalize_day", "verify"}


def epoch_to_timestamp(col: Column, rule: str = "materialize") -> Column:
    """Integer epoch of unknown unit -> timestamp, the unit chosen by magnitude."""
    nanos, micros, millis = EPOCH_RULES[rule]
    x = col.cast("bigint")
    size = x if rule in _SIGNED else F.abs(x)
    out = F.when(size >= nanos, F.timestamp_micros(F.call_function("div", x, F.lit(1000).cast("bigint"))))
    out = out.when(size >= micros, F.timestamp_micros(x))
    if millis is not None:
        out = out.when(size >= millis, F.timestamp_millis(x))
    # The seconds branch is guarded so that ANSI overflow cannot fire on larger units.
    smallest = millis if millis is not None else micros
    return out.otherwise(F.timestamp_seconds(F.when(size < smallest, x)))


def epoch_scale(max_value: Column) -> Column:
    """Name of the unit a column's largest epoch value points to."""
    nanos, micros, millis = EPOCH_RULES["verify"]
    return (F.when(max_value < millis, "seconds").when(max_value < micros, "milliseconds")
            .when(max_value < nanos, "microseconds").when(max_value.isNotNull(), "nanoseconds"))


def pick_time_column(schema: T.StructType, candidates=TIME_CANDIDATES) -> str:
    """First candidate present, else the first time- or integer-typed field."""
    names = {f.name for f in schema}
    for name in candidates:
        if name in names:
            return name
    for field in schema:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.LongType, T.IntegerType)):
            return field.name
    raise ValueError("no time column in " + schema.simpleString())


def normalize_time(df: DataFrame, candidates=TIME_CANDIDATES, rule: str = "materialize") -> DataFrame:
    """Replace the raw time columns by one canonical ``ts``."""
    name = pick_time_column(df.schema, candidates)
    field = df.schema[name].dataType
    raw = F.col(f"`{name}`")
    if isinstance(field, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        ts = raw.cast("timestamp")
    elif isinstance(field, T.StringType):
        ts = F.coalesce(epoch_to_timestamp(raw.try_cast("bigint"), rule), F.try_to_timestamp(raw))
    else:
        ts = epoch_to_timestamp(raw, rule)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("timestamp", "epoch", "ts")]
    return df.select(ts.alias("ts"), *kept)


def canonical_ts(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """``ts`` as a UTC timestamp beside the source's own time column, which is parsed too."""
    field = df.schema[col].dataType
    raw = F.col(col)
    parsed = F.try_to_timestamp(raw) if isinstance(field, T.StringType) else raw.cast("timestamp")
    return df.withColumn(col, parsed).withColumn("ts", F.col(col))


def parse_date(col: Column) -> Column:
    """Dates written as 2024-01-30, 20240130 or 2024/01/30; anything else is null."""
    return F.coalesce(F.try_to_date(col, "y-M-d"), F.try_to_date(col, "yyyyMMdd"), F.try_to_date(col, "y/M/d"))


def as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) and not isinstance(d, dt.datetime) else dt.date.fromisoformat(str(d)[:10])


def day_start(df: DataFrame, ts: str, d) -> Column:
    """Midnight of ``d`` in the type of ``df.ts``, so that comparisons reach the scan."""
    kind = df.schema[ts].dataType
    return F.lit(as_date(d).isoformat()).cast(kind)


def days_between(df: DataFrame, ts: str, start, end) -> Column:
    """Half-open range covering the days ``start``..``end`` inclusive."""
    after_end = as_date(end) + dt.timedelta(days=1)
    return (F.col(ts) >= day_start(df, ts, start)) & (F.col(ts) < day_start(df, ts, after_end))


def bin_start(ts: Column, seconds: int) -> Column:
    """Start of the fixed-length bin that holds ``ts``; bins count from the epoch."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds) * seconds)


def interval_seconds(interval: str) -> int:
    """Length of intervals such as ``h``, ``15min`` or ``1D``."""
    units = {"s": 1, "min": 60, "t": 60, "h": 3600, "d": 86400}
    digits = "".join(ch for ch in interval if ch.isdigit())
    return int(digits or 1) * units[interval[len(digits):].lower()]


def season(month: Column) -> Column:
    return (F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring")
            .when(month.isin(6, 7, 8), "summer").when(month.isNotNull(), "fall"))


def time_features(df: DataFrame, ts: str) -> DataFrame:
    """Hour, weekday (Monday 0), month and season of ``ts``."""
    return df.withColumns({
        "hour": F.hour(ts), "day_of_week": F.weekday(ts), "month": F.month(ts), "season": season(F.month(ts)),
    })


def week_of_year(day: Column) -> Column:
    """Week number whose weeks start on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) - 1 + 7 - (F.dayofweek(day) - 1)) / 7).cast("int")
