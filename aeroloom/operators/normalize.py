"""Wide-table normalisation: renames, conformance, unpivot and derived columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from aeroloom import vocab
from aeroloom.functions import air
from aeroloom.functions.numbers import numeric


def _schema(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def standardize(df: DataFrame, source: str) -> DataFrame:
    """Source field names -> canonical names; when two columns end up equal the first is kept."""
    renames = vocab.RENAMES[source]
    chosen: dict[str, str] = {}
    for name in df.columns:
        chosen.setdefault(renames.get(name, name), name)
    return df.select([F.col(f"`{name}`").alias(new) for new, name in chosen.items()])


def float_coords(df: DataFrame, pairs) -> DataFrame:
    """Per (float copy, original): fill the copy from the original where it is null."""
    types = {f.name: f.dataType for f in df.schema}
    updates = {}
    for copy, original in pairs:
        options = [numeric(F.col(c), types[c]) for c in (copy, original) if c in types]
        updates[copy] = F.coalesce(*options) if options else F.lit(None).cast("double")
    return df.withColumns(updates)


def conform(df: DataFrame, schema, on_bad_cast: str = "null") -> DataFrame:
    """Exactly the columns of ``schema`` in its order: missing ones null, extra ones dropped.

    A value that does not cast becomes null.  ``on_bad_cast='keep'`` leaves the original column when any of
    its values fails (one aggregate pass decides); ``'fail'`` raises at run time.
    """
    fields = _schema(schema).fields
    have = {f.name: f.dataType for f in df.schema}
    changed = [f for f in fields if f.name in have and have[f.name] != f.dataType]
    keep: set[str] = set()
    if on_bad_cast == "keep" and changed:
        bad = df.agg(*[
            F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull())
            .alias(f.name) for f in changed]).first()
        keep = {f.name for f in changed if bad[f.name]}
    out = []
    for f in fields:
        col = F.col(f"`{f.name}`")
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType or f.name in keep:
            out.append(col)
        elif on_bad_cast == "fail":
            out.append(col.cast(f.dataType).alias(f.name))
        else:
            out.append(col.try_cast(f.dataType).alias(f.name))
    return df.select(out)


def ensure_columns(df: DataFrame, schema) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, as nulls."""
    missing = [f for f in _schema(schema) if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def enforce_types(df: DataFrame, types: dict[str, str], parity: bool = False) -> DataFrame:
    """Cast the named columns; ``parity=True`` turns a null boolean into false."""
    updates = {}
    for name, kind in types.items():
        if name in df.columns:
            col = F.col(name).try_cast(kind)
            updates[name] = F.coalesce(col, F.lit(False)) if parity and kind in ("boolean", "bool") else col
    return df.withColumns(updates) if updates else df


def unpivot_metrics(df: DataFrame, ids, metrics, metric_filter=None) -> DataFrame:
    """Wide -> long (``metric_name``, ``value``); null cells give no row.

    ``ids`` are names or aliased columns.  ``metric_filter`` narrows the metrics before the unpivot, which
    is what keeps the other columns out of the scan.
    """
    types = {f.name: f.dataType for f in df.schema}
    wanted = [m for m in metrics if m in types and (metric_filter is None or m in metric_filter)]
    id_cols = [F.col(i) if isinstance(i, str) else i for i in ids]
    id_names = df.select(*id_cols).columns
    # A metric named like an id is moved aside for the unpivot; all others keep their name.
    aside = {m: f"metric {m}" for m in wanted if m in id_names}
    flat = df.select(*id_cols, *[numeric(F.col(m), types[m]).alias(aside.get(m, m)) for m in wanted])
    if not wanted:
        return flat.select(*id_names, F.lit("").alias("metric_name"), F.lit(None).cast("double").alias("value")).limit(0)
    long = (flat.unpivot(id_names, [aside.get(m, m) for m in wanted], "metric_name", "value")
            .filter(F.col("value").isNotNull()))
    if aside:
        back = F.col("metric_name")
        long = long.withColumn("metric_name", F.when(back.startswith("metric "), F.expr("substring(metric_name, 8)")).otherwise(back))
    return long


def has_reading(df: DataFrame, metrics) -> DataFrame:
    """Rows with at least one of the metrics: the rows an unpivot would keep."""
    types = {f.name: f.dataType for f in df.schema}
    return df.filter(F.coalesce(*[numeric(F.col(m), types[m]) for m in metrics if m in types]).isNotNull())


def source_long(df: DataFrame, source: str, metrics=None, ts: str = "ts") -> DataFrame:
    """One source's wide rows -> the long fact."""
    pairs = vocab.COORDS[source]
    (lat, _), (lon, _) = pairs
    wide = float_coords(df, pairs).filter(F.col(ts).isNotNull())
    long = unpivot_metrics(
        wide,
        [F.col(ts).alias("timestamp"), "native_sensor_id", F.col(lat).alias("latitude"), F.col(lon).alias("longitude")],
        vocab.METRICS[source], metrics)
    return long.select(
        "timestamp", "native_sensor_id", "metric_name", "value", "latitude", "longitude",
        air.geo_point(F.col("latitude"), F.col("longitude")).alias("geog"))


#: The known metrics in order; a metric's place here is its number.
NUMBERED = sorted({m for names in vocab.METRICS.values() for m in names})
#: What stands for ``metric_name`` in `numbered`: the text of names that have no number, and the number.
NAME_PARTS = ("metric text", "metric number")


def numbered(df: DataFrame) -> DataFrame:
    """Long rows as a shuffle should carry them: the metric as a number and last, beside the value, so that rows of one reading, which
    follow each other, differ in few bytes and in one place.  A name without a number stays as text; `named` is the way back.
    """
    name = F.col("metric_name")
    number = F.create_map(*[x for i, m in enumerate(NUMBERED) for x in (F.lit(m), F.lit(i).cast("smallint"))])[name]
    others = [c for c in df.columns if c not in ("metric_name", "value")]
    text = F.when(number.isNull(), name)
    return df.select(*others, text.alias(NAME_PARTS[0]), *[c for c in df.columns if c == "value"], number.alias(NAME_PARTS[1]))


def named(df: DataFrame) -> DataFrame:
    """`numbered` rows with their ``metric_name`` again."""
    text, number = map(F.col, (f"`{c}`" for c in NAME_PARTS))
    name = F.coalesce(F.get(F.array(*map(F.lit, NUMBERED)), number), text).alias("metric_name")
    return df.select(*[c for c in df.columns if c not in NAME_PARTS], name)


def unpivot_from_manifest(df: DataFrame, source: str, manifest=vocab.MANIFEST, ids=("ts", "native_sensor_id")) -> DataFrame:
    """Unpivot the metrics the manifest lists for ``source``."""
    return unpivot_metrics(df, list(ids), [m for m in manifest[source]["metrics"] if m not in ids])


def melt_numeric(df: DataFrame, ids, reserved=vocab.RESERVED_MELT) -> DataFrame:
    """Unpivot every column that holds at least one number; ids and reserved names are left out."""
    skip = set(ids) | set(reserved)
    types = {f.name: f.dataType for f in df.schema if f.name not in skip}
    candidates = [c for c, t in types.items() if isinstance(t, (T.NumericType, T.BooleanType, T.StringType))]
    if not candidates:
        return unpivot_metrics(df, list(ids), [])
    # One aggregate row decides which columns count as metrics.
    seen = df.agg(*[F.max(numeric(F.col(f"`{c}`"), types[c]).isNotNull()).alias(f"c{i}")
                    for i, c in enumerate(candidates)]).first()
    return unpivot_metrics(df, list(ids), [c for i, c in enumerate(candidates) if seen[i]])


def drop_columns(df: DataFrame, cols) -> DataFrame:
    return df.drop(*cols)


def tag_source(df: DataFrame, source: str, category: str) -> DataFrame:
    """Source literals and the aliases dashboards expect."""
    return df.withColumns({
        "metric": F.col("metric_name"), "value": F.col("avg_value"),
        "sensor_source": F.lit(source), "sensor_category": F.lit(category),
    })


def resolve_logical(df: DataFrame, name: str, candidates=None) -> DataFrame:
    """Add ``name`` from the first candidate column that holds a usable value anywhere.

    The choice is made once for the whole column, by one aggregate row.  A time column is chosen by
    presence.  Columns are addressed by position, since history headers may differ only in case.
    """
    candidates = candidates or vocab.LOGICAL_CANDIDATES[name]
    at = {}
    for i, column in enumerate(df.columns):
        at.setdefault(column, i)
    present = [c for c in candidates if c in at]
    safe = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    types = [f.dataType for f in df.schema]

    def usable(c: str) -> Column:
        col = F.col(f"c{at[c]}")
        if name == "timestamp":
            return F.try_to_timestamp(col) if isinstance(types[at[c]], T.StringType) else col.try_cast("timestamp")
        return numeric(col, types[at[c]])

    chosen = None
    if present:
        seen = safe.agg(*[F.max(usable(c).isNotNull()).alias(f"u{i}") for i, c in enumerate(present)]).first()
        chosen = next((c for i, c in enumerate(present) if seen[i]), None)
    if chosen is None:
        return df
    others = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c != name]
    return safe.select(*others, usable(chosen).alias(name))


def calculated_fields(df: DataFrame, as_of) -> DataFrame:
    """Dashboard fields: sample quality, days since the reading, Fahrenheit and AQI bucket of ``avg_value``."""
    is_temp = F.col("metric_name").isin("temperature", "temperature_c")
    is_pm = F.col("metric_name").isin("pm2_5", "pm25")
    return df.withColumns({
        "data_quality_score": air.quality_score(F.col("samples")),
        "days_since_last_reading": F.date_diff(F.lit(as_of).cast("date"), F.to_date("day_ts")),
        "temperature_f": F.when(is_temp, air.fahrenheit(F.col("avg_value"))),
        "aqi_category": F.when(is_pm, air.aqi_bucket(F.col("avg_value"))),
    })


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name; columns one side lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()
