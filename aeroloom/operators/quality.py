"""Data-quality checks.  Every check is a DataFrame of findings or of one row per checked unit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from aeroloom import vocab
from aeroloom.functions.numbers import numeric
from aeroloom.functions.times import as_date, days_between, epoch_scale, epoch_to_timestamp
from aeroloom.operators.joins import align_counts, date_spine
from aeroloom.operators.rollups import rows_per_day


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def _rows_to_lines(row: DataFrame, entries) -> DataFrame:
    """One aggregate row -> one line per entry (a list of structs)."""
    return row.select(F.inline(F.array(*entries)))


# Types a check treats as equal, by family.
_FAMILY = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "double", "double": "double",
           "timestamp": "timestamp", "timestamp_ntz": "timestamp", "string": "string", "boolean": "boolean",
           "date": "date"}


def family(kind: str) -> str:
    return _FAMILY.get(kind, kind)


def conformance(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Per expected column: presence, type match and number of values that do not cast to the expected type.

    A missing column counts every row as bad.  One aggregate pass.
    """
    have = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, (name, kind) in enumerate(expected.items()):
        if name in have:
            col = F.col(f"`{name}`")
            aggs.append(F.count_if(col.isNotNull() & col.cast("string").try_cast(kind).isNull()).alias(f"bad{i}"))
    entries = [F.struct(
        F.lit(name).alias("column_name"), F.lit(kind).alias("expected_type"),
        F.lit(have.get(name)).cast("string").alias("actual_type"),
        F.lit(name in have and family(have[name]) == family(kind)).alias("type_ok"),
        (F.col(f"bad{i}") if name in have else F.col("rows")).alias("bad_rows"),
        F.col("rows").alias("total_rows")) for i, (name, kind) in enumerate(expected.items())]
    return _rows_to_lines(df.agg(*aggs), entries)


def check_null_coverage(df: DataFrame, critical, min_coverage: float) -> DataFrame:
    """Share of non-null values per critical column; a missing column and an empty table fail.

    ``critical`` lists the columns, or names the source whose critical columns are meant.
    """
    critical = vocab.CRITICAL_COLUMNS[critical] if isinstance(critical, str) else critical
    present = [c for c in critical if c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n {c}") for c in present])
    entries = []
    for c in critical:
        n = F.col(f"`n {c}`") if c in present else F.lit(0).cast("bigint")
        share = F.coalesce(F.try_divide(n.cast("double"), F.col("rows").cast("double")), F.lit(0.0))
        entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(c in present).alias("present"),
                                n.alias("non_null"), share.alias("coverage"), (share >= min_coverage).alias("ok")))
    return _rows_to_lines(row, entries)


def null_rates(df: DataFrame, ts: str, metrics) -> DataFrame:
    """Per day: records, nulls and null percentage of each metric."""
    total = F.count(F.lit(1))
    aggs = [total.alias("total_records")]
    for m in metrics:
        bad = F.count_if(F.col(m).isNull())
        aggs += [bad.alias(f"null_{m}"), F.round(bad * 100.0 / total, 2).alias(f"null_{m}_pct")]
    return df.groupBy(F.to_date(ts).alias("date")).agg(*aggs)


def check_null_rate(df: DataFrame, ts: str, metrics, max_pct: float = vocab.MAX_NULL_PCT) -> DataFrame:
    """(day, metric) pairs whose null percentage is above the limit."""
    rates = null_rates(df, ts, metrics)
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"null_{m}").alias("null_count"),
                                 F.col(f"null_{m}_pct").alias("null_pct")) for m in metrics])
    return (rates.select("date", "total_records", F.inline(entries)).filter(F.col("null_pct") > max_pct))


def check_days(df: DataFrame, ts: str, start, end, min_rows: int = 100) -> DataFrame:
    """Days of the range without rows or with fewer than ``min_rows``."""
    counts = rows_per_day(df, ts, start, end)
    one = _spark(df).range(1).select()
    spine = date_spine(one, start, end)
    n = F.coalesce("row_count", F.lit(0)).cast("bigint")
    return (spine.join(counts, "date", "left")
            .select("date", n.alias("row_count"),
                    F.when(n == 0, "missing").when(n < min_rows, "low").alias("issue"))
            .filter(F.col("issue").isNotNull()))


def metric_coverage(wide: DataFrame, ts: str, metrics, sensor: str = "native_sensor_id") -> DataFrame:
    """Valid and null counts and reporting devices per day and metric, from the wide table.

    The long fact cannot serve here: its unpivot has dropped the nulls.  Each metric is aggregated per
    (day, sensor) first, so the unpivot runs on far fewer rows.
    """
    types = {f.name: f.dataType for f in wide.schema}
    cells = [numeric(F.col(m), types[m]).isNotNull() for m in metrics]
    per_sensor = wide.groupBy(F.to_date(ts).alias("date"), F.col(sensor).alias("device")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(f"n {m}") for m, c in zip(metrics, cells)])
    lines = per_sensor.select("date", "device", "rows", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"`n {m}`").alias("valid")) for m in metrics])))
    return lines.groupBy("date", "metric").agg(
        F.sum("rows").alias("reading_count"), F.count_if(F.col("valid") > 0).alias("device_count"),
        F.sum(F.col("rows") - F.col("valid")).alias("null_count"), F.sum("valid").alias("valid_count"))


def check_metric_coverage(wide: DataFrame, ts: str, start, end, metrics, threshold: float) -> DataFrame:
    """(day, metric) pairs under the coverage threshold, and days of the range without any row."""
    rows = wide.filter(days_between(wide, ts, start, end))
    cover = metric_coverage(rows, ts, metrics)
    share = F.col("valid_count").cast("double") / (F.col("valid_count") + F.col("null_count")).cast("double")
    low = (cover.withColumn("coverage", share).filter(F.col("coverage") < threshold)
           .select("date", "metric", "coverage", F.lit("low coverage").alias("issue")))
    missing = (check_days(wide, ts, start, end, 1)
               .select("date", F.lit(None).cast("string").alias("metric"), F.lit(0.0).alias("coverage"),
                       F.lit("missing day").alias("issue")))
    return low.unionByName(missing)


def check_rollup_ratio(long_df: DataFrame, hourly: DataFrame, samples_per_hour: float,
                       low: float = vocab.HOURLY_RATIO[0], high: float = vocab.HOURLY_RATIO[1]) -> DataFrame:
    """Days whose hourly rows are missing or off the number the long rows imply."""
    a = rows_per_day(long_df, "timestamp").withColumnRenamed("row_count", "long_count")
    b = rows_per_day(hourly, "hour_ts").withColumnRenamed("row_count", "hourly_count")
    expected = F.col("long_count") / F.lit(float(samples_per_hour))
    ratio = F.try_divide(F.col("hourly_count").cast("double"), expected)
    # A day with long rows and no hourly row has ratio zero; the missing case is named first.
    return (align_counts(a, b, "date").withColumn("ratio", ratio)
            .withColumn("issue", F.when((F.col("long_count") > 0) & (F.col("hourly_count") == 0), "hourly missing")
                        .when(F.col("ratio").isNull() | ~F.col("ratio").between(low, high), "ratio out of range"))
            .filter(F.col("issue").isNotNull()))


def expected_metrics(spark: SparkSession, manifest=vocab.MANIFEST, source: str | None = None) -> DataFrame:
    names = sorted({m for s, v in manifest.items() if source in (None, s) for m in v["metrics"]})
    return spark.createDataFrame([Row(metric_name=m) for m in names], "metric_name string")


def present_expected(present: DataFrame, expected: DataFrame) -> DataFrame:
    """Metrics both present and expected."""
    return present.select("metric_name").intersect(expected.select("metric_name"))


def set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks.

    The anti join behind ``subtract`` shuffles all rows of ``b``, and those of a frequent value to one task; counted per
    value first, each task sends a value once.
    """
    counted = b.groupBy(*b.columns).agg(F.count(F.lit(1)).alias("rows of b")).filter(F.col("rows of b") > 0)
    return a.subtract(counted.select(b.columns))


def manifest_coverage(long_df: DataFrame, manifest, d, threshold: float = vocab.MIN_METRIC_FRACTION) -> DataFrame:
    """Share of the manifest's metrics seen on a day, with the missing ones."""
    expected = expected_metrics(_spark(long_df), manifest)
    seen = (long_df.filter(days_between(long_df, "timestamp", d, d)).select("metric_name").distinct()
            .withColumn("seen", F.lit(True)))
    hit = F.coalesce("seen", F.lit(False))
    # The list is bounded by the manifest.
    return expected.join(seen, "metric_name", "left").agg(
        F.count(F.lit(1)).alias("expected_metric_count"), F.count_if(hit).alias("present_metric_count"),
        (F.count_if(hit) / F.count(F.lit(1))).alias("coverage_fraction"),
        F.array_sort(F.collect_list(F.when(~hit, F.col("metric_name")))).alias("missing_metrics"),
        ((F.count_if(hit) / F.count(F.lit(1))) >= threshold).alias("ok"))


def compare_metrics(wide: DataFrame, manifest, source: str) -> DataFrame:
    """Expected, present and extra metrics of a source; present means at least one non-null value."""
    columns = [c for c in wide.columns if c not in vocab.RESERVED]
    present = wide.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns])
    lines = _rows_to_lines(present, [F.struct(F.lit(c).alias("metric_name"), F.col(f"`{c}`").alias("non_null"))
                                     for c in columns])
    expected = expected_metrics(_spark(wide), manifest, source).withColumn("expected", F.lit(True))
    n = F.coalesce("non_null", F.lit(0)).cast("bigint")
    is_expected = F.coalesce("expected", F.lit(False))
    return (lines.join(expected, "metric_name", "full").select(
        "metric_name", n.alias("non_null"),
        F.when(is_expected & (n > 0), "present").when(is_expected, "missing")
        .when(n > 0, "extra").alias("status")).filter(F.col("status").isNotNull()))


def row_thresholds(defaults=vocab.ROW_THRESHOLDS, config=None, override=None) -> dict[str, int]:
    """Merged thresholds: defaults, then configuration, then override."""
    return {**defaults, **(config or {}), **(override or {})}


def check_row_thresholds(frames: dict[str, tuple[DataFrame, str | None]], d, thresholds: dict[str, int]) -> DataFrame:
    """Rows of a day (all rows where no time column is named) against the minimum, per table.

    A table with a threshold but no frame fails.
    """
    out = None
    for name, minimum in thresholds.items():
        need = F.lit(minimum).cast("bigint").alias("min_required")
        if name in frames:
            df, ts = frames[name]
            rows = df.filter(days_between(df, ts, d, d)) if ts else df
            part = rows.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count", need, (F.col("row_count") >= minimum).alias("ok"))
        else:
            any_df = next(iter(frames.values()))[0]
            part = _spark(any_df).range(1).select(
                F.lit(name).alias("table_name"), F.lit(None).cast("bigint").alias("row_count"), need,
                F.lit(False).alias("ok"))
        out = part if out is None else out.unionByName(part)
    return out


def freshness_days(df: DataFrame, ts: str, now, max_lag: int = 1) -> DataFrame:
    """Whole days since the latest row; exit code 0 fresh, 1 stale, 2 empty."""
    lag = F.date_diff(F.lit(as_date(now)), F.to_date("latest_ts"))
    return df.agg(F.max(ts).alias("latest_ts")).select(
        "latest_ts", lag.alias("lag_days"),
        F.when(F.col("latest_ts").isNull(), 2).when(lag > max_lag, 1).otherwise(0).alias("exit_code"))


def freshness_hours(df: DataFrame, ts: str, now, warn: float = 26, error: float = 36) -> DataFrame:
    """Hours since the latest row with pass, warn or error."""
    now = F.lit(str(now)).cast("timestamp")
    hours = (F.unix_micros(now) - F.unix_micros(F.col("latest_ts").cast("timestamp"))) / 3.6e9
    return df.agg(F.max(ts).alias("latest_ts")).select(
        "latest_ts", hours.alias("age_hours"),
        F.when(hours.isNull() | (hours > error), "error").when(hours > warn, "warn").otherwise("pass").alias("status"))


def staging_presence(partitions: DataFrame, sources, d) -> DataFrame:
    """Expected (source, day) staging partitions that are absent; ``partitions`` has source and dt."""
    expected = _spark(partitions).createDataFrame([(s, as_date(d)) for s in sources], "source string, dt date")
    return expected.join(partitions.select("source", F.col("dt").cast("date").alias("dt")), ["source", "dt"], "left_anti")


def reconcile(materialized: DataFrame, external: DataFrame | None, start, end, ts: str = "ts") -> DataFrame:
    """Rows per day of two layers; OK when equal, WARN when not, SKIP without the second layer.

    Every day of the range is listed.
    """
    spine = date_spine(_spark(materialized).range(1).select(), start, end)
    mat = rows_per_day(materialized, ts, start, end).withColumnRenamed("row_count", "mat_rows")
    out = spine.join(mat, "date", "left").withColumn("mat_rows", F.coalesce("mat_rows", F.lit(0)))
    if external is None:
        null = F.lit(None).cast("bigint")
        return out.select("date", null.alias("ext_rows"), "mat_rows", null.alias("delta"), F.lit("SKIP").alias("status"))
    ext = rows_per_day(external, ts, start, end).withColumnRenamed("row_count", "ext_rows")
    out = out.join(ext, "date", "left").withColumn("ext_rows", F.coalesce("ext_rows", F.lit(0)))
    delta = F.col("mat_rows") - F.col("ext_rows")
    return out.select("date", "ext_rows", "mat_rows", delta.alias("delta"),
                      F.when(delta == 0, "OK").otherwise("WARN").alias("status"))


def column_tests(df: DataFrame, not_null=(), unique=(), accepted: dict[str, list] | None = None) -> DataFrame:
    """Failures per (test, column): nulls, duplicated values, values outside a list."""
    accepted = accepted or {}
    aggs = [F.count_if(F.col(c).isNull()).alias(f"nn {c}") for c in not_null]
    aggs += [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(v))).alias(f"av {c}") for c, v in accepted.items()]
    entries = [F.struct(F.lit("not_null").alias("test"), F.lit(c).alias("column_name"), F.col(f"`nn {c}`").alias("failures"))
               for c in not_null]
    entries += [F.struct(F.lit("accepted_values").alias("test"), F.lit(c).alias("column_name"),
                         F.col(f"`av {c}`").alias("failures")) for c in accepted]
    parts = [_rows_to_lines(df.agg(*aggs), entries)] if entries else []
    for c in unique:
        parts.append(check_unique(df.filter(F.col(c).isNotNull()), [c]).agg(F.count(F.lit(1)).alias("failures"))
                     .select(F.lit("unique").alias("test"), F.lit(c).alias("column_name"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def time_geo_diagnostics(df: DataFrame, cols=None) -> DataFrame:
    """Integer time columns with range, unit and ISO range; rows without ``ts``; non-numeric coordinates.

    Lines: kind ``epoch`` per integer time column, ``missing_ts``, ``bad_coordinate`` per coordinate column
    and ``redundant_time`` with the number of surplus integer time columns.
    """
    types = {f.name: f.dataType for f in df.schema}
    named = lambda n: any(w in n.lower() for w in ("epoch", "ts", "time"))
    integer = (T.IntegerType, T.LongType)
    epochs = cols or [n for n, t in types.items() if isinstance(t, integer) and named(n)]
    coords = [n for n in ("latitude", "longitude", "lat", "lon") if n in types]
    ts_cols = [n for n in ("ts", "timestamp") if isinstance(types.get(n), (T.TimestampType, T.TimestampNTZType))]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(epochs):
        aggs += [F.min(c).cast("bigint").alias(f"min{i}"), F.max(c).cast("bigint").alias(f"max{i}"), F.count(c).alias(f"n{i}")]
    aggs.append((F.count_if(F.coalesce(*ts_cols).isNull()) if ts_cols else F.count(F.lit(1))).alias("no_ts"))
    for i, c in enumerate(coords):
        aggs.append(F.count_if(F.col(c).isNotNull() & numeric(F.col(c), types[c]).isNull()).alias(f"coord{i}"))

    def iso(col: Column, unit: Column) -> Column:
        at = (F.when(unit == "seconds", F.timestamp_seconds(F.when(unit == "seconds", col)))
              .when(unit == "milliseconds", F.timestamp_millis(F.when(unit == "milliseconds", col)))
              .when(unit == "microseconds", F.timestamp_micros(col))
              .when(unit == "nanoseconds", F.timestamp_micros(F.call_function("div", col, F.lit(1000).cast("bigint")))))
        return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    null_long, null_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")

    def line(kind, name, rows, low=null_long, high=null_long, unit=null_text, a=null_text, b=null_text):
        return F.struct(F.lit(kind).alias("kind"), F.lit(name).cast("string").alias("column_name"),
                        rows.cast("bigint").alias("row_count"), low.alias("min_value"), high.alias("max_value"),
                        unit.alias("scale"), a.alias("iso_min"), b.alias("iso_max"))

    entries = []
    for i, c in enumerate(epochs):
        unit = epoch_scale(F.col(f"max{i}"))
        entries.append(line("epoch", c, F.col(f"n{i}"), F.col(f"min{i}"), F.col(f"max{i}"), unit,
                            iso(F.col(f"min{i}"), unit), iso(F.col(f"max{i}"), unit)))
    entries.append(line("missing_ts", "ts", F.col("no_ts")))
    entries += [line("bad_coordinate", c, F.col(f"coord{i}")) for i, c in enumerate(coords)]
    surplus = sum(1 for n in ("timestamp", "epoch") if isinstance(types.get(n), integer)) - 1 if ts_cols else 0
    entries.append(line("redundant_time", None, F.lit(max(surplus, 0))))
    return _rows_to_lines(df.agg(*aggs), entries)


def field_coverage(df: DataFrame, keys, fields=None) -> DataFrame:
    """Non-null count, percentage and reporting sensors per key, field category and field.

    Counted per (key, sensor) on the wide table before the fields are turned to rows.
    """
    categories = fields or vocab.FIELD_CATEGORIES
    pairs = [(cat, f) for cat, fs in categories.items() for f in fs]
    per = df.groupBy(*keys, F.col("native_sensor_id").alias("device")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(f)).alias(f"n {f}") for _, f in pairs if f in df.columns])
    lines = per.select(*keys, "device", "rows", F.inline(F.array(*[F.struct(
        F.lit(cat).alias("category"), F.lit(f).alias("field"),
        (F.col(f"`n {f}`") if f in df.columns else F.lit(0).cast("bigint")).alias("n")) for cat, f in pairs])))
    return lines.groupBy(*keys, "category", "field").agg(
        F.sum("rows").alias("total_records"), F.sum("n").alias("non_null"),
        F.round(F.sum("n") / F.sum("rows") * 100, 1).alias("coverage_pct"),
        F.count_if(F.col("n") > 0).alias("sensors_with_data"))


def category_coverage(coverage: DataFrame, keys) -> DataFrame:
    """Mean field coverage per category."""
    return coverage.groupBy(*keys, "category").agg(
        F.round(F.avg(F.col("non_null") / F.col("total_records") * 100), 4).alias("avg_coverage_pct"))


def best_device(df: DataFrame, fields=("pm1_0", "pm2_5", "pm10")) -> DataFrame:
    """The sensor whose rows fill the most of ``fields``; ties go to the smaller id."""
    filled = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    return (df.groupBy("native_sensor_id").agg(F.max(filled).alias("fields_filled"))
            .orderBy(F.desc("fields_filled"), "native_sensor_id").limit(1))


def quality_report(wide: DataFrame, long_df: DataFrame, hourly: DataFrame, start, end, metrics, ts: str = "ts", min_rows: int = 100,
                   max_null_pct: float = vocab.MAX_NULL_PCT, threshold: float | None = None, samples_per_hour: float = 1.0) -> DataFrame:
    """All findings of a range of days in one table: ``check``, ``status`` and the finding's fields as JSON in ``details``.

    Runs `check_days`, `check_null_rate`, `check_metric_coverage` and `check_rollup_ratio`; a check without findings has one
    line with status ``ok``.  The frames are those of the range.  ``threshold`` is the share of valid values below which a
    metric's day is reported, by default the least of the configured ones.
    """
    inside = lambda df, col: df.filter(F.to_date(col).between(F.lit(as_date(start)), F.lit(as_date(end))))
    wide = inside(wide, ts)
    least = min(vocab.COVERAGE_THRESHOLDS.values()) if threshold is None else threshold
    checks = {
        "days": check_days(wide, ts, start, end, min_rows),
        "null_rate": check_null_rate(wide, ts, metrics, max_null_pct),
        "metric_coverage": check_metric_coverage(wide, ts, start, end, metrics, least),
        "rollup_ratio": check_rollup_ratio(inside(long_df, "timestamp"), inside(hourly, "hour_ts"), samples_per_hour)}
    parts = []
    for name, found in checks.items():
        lines = found.select(F.lit(name).alias("check"), F.lit("finding").alias("status"), F.to_json(F.struct(*found.columns)).alias("details"))
        none = lines.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
            F.lit(name).alias("check"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("details"))
        parts += [lines, none]
    return reduce(lambda a, b: a.unionByName(b), parts)
