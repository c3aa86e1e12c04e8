"""Partitioned Parquet tables: replacement, merging and maintenance.

Tables are folders partitioned by ``dt``.  Every write is safe to repeat for the same days.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from aeroloom.functions.times import as_date
from aeroloom.operators.normalize import NAME_PARTS, conform, named, numbered
from aeroloom.operators.rollups import dedupe_last
from aeroloom.session import saved, shuffles_dropped
from aeroloom.sources.landing import day_range


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete one folder of a table."""
    fs, p = _folder(spark, path)
    return fs.delete(p, True)


def days_present(spark: SparkSession, path: str) -> list[str]:
    """Days of a table's ``dt=`` folders that hold files, from the file system's listing alone: no data is scanned."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("dt=")]
    filled = [d for d in found if any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(d))]
    return sorted(d.getName()[3:] for d in filled)


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``prefix``N below a path, ascending."""
    fs, p = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def layout(df: DataFrame, dt_col: str = "dt", cluster_cols=("native_sensor_id", "metric_name")) -> DataFrame:
    """Rows gathered by day into files of even size and sorted by the cluster columns.

    ``rebalance`` splits a day that is too large for one task and joins small ones; a plain
    ``repartition(dt)`` would write a heavy day from a single task.
    """
    return df.hint("rebalance", dt_col).sortWithinPartitions(dt_col, *cluster_cols)


def _light(df: DataFrame, made: dict[str, Column]):
    """(light rows, their way back) for a shuffle and sort: the metric numbered, columns that follow from others left out."""
    to, back = (numbered, named) if "metric_name" in df.columns else (lambda rows: rows,) * 2
    return to(df.drop(*made)), lambda rows: back(rows).withColumns(made).select(df.columns)


def _narrowed(df: DataFrame, least: int = 8):
    """(narrow rows, their way back): double columns, most of them null in a wide row, as one list of those that are set and the bits
    of their places, so that a sort holds what its files say and not a cell for every column."""
    cells = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)][:62]
    if len(cells) < least:
        return df, lambda rows: rows
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(cells)])
    narrow = df.select(*[c for c in df.columns if c not in cells], bits.alias("cells set"), F.array_compact(F.array(*cells)).alias("cells"))

    def widened(rows: DataFrame) -> DataFrame:
        at = {c: i for i, c in enumerate(cells)}
        bits = F.col("cells set")
        cell = lambda i: F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.get("cells", F.bit_count(bits.bitwiseAND(F.lit((1 << i) - 1)))))
        return rows.select([cell(at[c]).alias(c) if c in at else F.col(c) for c in df.columns])

    return narrow, widened


def with_dt(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("dt", F.to_date(ts))


def write_landing(df: DataFrame, root: str, source: str, agg: str = "raw", force: bool = False,
                  ts: str = "timestamp") -> None:
    """Land rows under source/agg/day, the day taken from each row.

    Rows whose time does not parse are dropped.  Days already landed are left alone unless ``force``.
    """
    kind = df.schema[ts].dataType
    parsed = F.try_to_timestamp(ts) if isinstance(kind, T.StringType) else F.col(ts).cast("timestamp")
    rows = (df.withColumn(ts, parsed).filter(F.col(ts).isNotNull())
            .withColumns({"source": F.lit(source), "agg": F.lit(agg), "dt": F.to_date(ts)}))
    spark = df.sparkSession
    if not force and exists(spark, f"{root}/source={source}/agg={agg}"):
        landed = days_present(spark, f"{root}/source={source}/agg={agg}")
        rows = rows.filter(~F.col("dt").isin(landed)) if landed else rows
    narrow, widened = _narrowed(rows)
    out = widened(layout(narrow, "dt", [c for c in ("native_sensor_id", ts) if c in df.columns]))
    writer = out.write.partitionBy("source", "agg", "dt").option("compression", "snappy")
    if force:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    with shuffles_dropped(spark):
        writer.parquet(root)


def replace_day(df: DataFrame, path: str, d, cluster_cols=("native_sensor_id", "metric_name")) -> None:
    """Replace one day's partition; an empty result clears it."""
    replace_window(df.withColumn("dt", F.lit(as_date(d))), path, d, d, cluster_cols)


def replace_window(df: DataFrame, path: str, start, end, cluster_cols=("native_sensor_id", "metric_name"),
                   made: dict[str, Column] | None = None, dealt: bool = False) -> None:
    """Replace the days ``start``..``end`` in one job; ``df`` has ``dt``.

    ``made`` has columns of ``df`` as expressions of its others, so that they need not be shuffled and sorted.  ``dealt`` says that
    tasks hold rows of few days already, in order, so that they are written as they lie.

    New partitions are swapped in when the job commits, so a failed job leaves the old ones.  Days without new
    rows are removed; which days got rows is observed by the write itself, as bits, which a retried task
    cannot distort.
    """
    days = day_range(start, end)
    offset = F.datediff("dt", F.lit(days[0]))
    # 60 days per long: one bit per day.
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(offset, F.lit(60)).cast("int"))
    words = [F.coalesce(F.bit_or(F.when(offset.between(i * 60, i * 60 + 59), bit)), F.lit(0).cast("bigint")).alias(f"w{i}")
             for i in range((len(days) + 59) // 60)]
    seen = Observation()
    inside = df.filter(F.col("dt").between(F.lit(days[0]), F.lit(days[-1])))
    cols = [c for c in cluster_cols if c in df.columns]
    if not dealt:
        light, back = _light(inside, made or {})
        inside = back(layout(light, "dt", [part for c in cols for part in (NAME_PARTS if c == "metric_name" else (c,))]))
    with shuffles_dropped(df.sparkSession):
        (inside.observe(seen, *words).write.mode("overwrite").option("compression", "zstd")
         .option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path))
    found = seen.get
    for i, d in enumerate(days):
        if not (found.get(f"w{i // 60}", 0) or 0) >> (i % 60) & 1:
            remove(df.sparkSession, f"{path}/dt={d.isoformat()}")


def replace_all(df: DataFrame, path: str, partition_by=()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def upsert(target: DataFrame, source: DataFrame, keys, value: str = "value", only_if_changed: bool = False,
           parity: bool = False, policy: str = "replace") -> DataFrame:
    """Target after merging ``source`` by ``keys``; the source has one row per key.

    ``policy='keep'`` lets existing rows win.  ``only_if_changed`` leaves equal rows as they are, which shows
    only in other columns; a change to or from null counts unless ``parity``.
    """
    others = [c for c in target.columns if c not in set(keys)]
    s = source.select(*keys, F.struct(*others).alias("s"))
    t = target.select(*keys, F.struct(*others).alias("t"))
    j = t.join(s, list(keys), "full")
    new, old = F.col(f"s.{value}"), F.col(f"t.{value}")
    take = F.col("t").isNull()
    if policy == "replace":
        changed = F.lit(True)
        if only_if_changed:
            changed = F.coalesce(new != old, F.lit(False)) if parity else ~new.eqNullSafe(old)
        take = take | (F.col("s").isNotNull() & changed)
    return j.select(*keys, F.when(take, F.col("s")).otherwise(F.col("t")).alias("row")).select(*keys, "row.*").select(target.columns)


def first_of(df: DataFrame, keys, seq: str | None = None) -> DataFrame:
    """One row per key: the least by ``seq``, then by the other columns in order."""
    others = [c for c in df.columns if c not in set(keys)]
    order = ([seq] if seq else []) + [c for c in others if c != seq]
    if not order:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("row")).select(*keys, "row.*").select(df.columns)


def insert_absent(target: DataFrame, source: DataFrame, keys, seq: str | None = None) -> DataFrame:
    """Rows of ``source`` whose key the target lacks, one per key: the first by ``seq``, then by all columns in order."""
    return first_of(source, keys, seq).join(target.select(*keys), list(keys), "left_anti").select(target.columns)


def append_absent(spark: SparkSession, path: str, source: DataFrame, keys, ts: str = "timestamp", seq: str | None = None) -> None:
    """Append the rows whose key is new; existing rows win.  The source is run once, and only its days are read."""
    rows = with_dt(source, ts)
    if not exists(spark, path):
        layout(first_of(rows, keys, seq), "dt", keys).write.partitionBy("dt").parquet(path)
        return
    rows = saved(rows, "append-source")
    target = _only_days(spark, path, rows)
    layout(insert_absent(target, rows, keys, seq), "dt", keys).write.mode("append").partitionBy("dt").parquet(path)


def _only_days(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """The table's partitions for the days in ``rows``; the list of days is bounded by the calendar."""
    days = [r.dt for r in rows.select("dt").distinct().collect()]
    return spark.read.parquet(path).filter(F.col("dt").isin(days) if days else F.lit(False))


def merge_into(spark: SparkSession, path: str, source: DataFrame, keys, value: str = "value", seq: str | None = None,
               ts: str = "timestamp", only_if_changed: bool = False, policy: str = "replace") -> None:
    """Upsert into a partitioned table by rewriting the touched days.

    The source is reduced to its last row per key first (by ``seq`` when given) and run once.  The merged days are written
    beside the table, then swapped in by partition, since a table cannot be overwritten while it is read.
    """
    rows = with_dt(source, ts)
    rows = dedupe_last(rows, keys, seq, value).drop(seq) if seq else rows
    if not exists(spark, path):
        layout(rows, "dt", keys).write.partitionBy("dt").parquet(path)
        return
    rows = saved(rows, "merge-source")
    target = _only_days(spark, path, rows)
    staged = f"{path.rstrip('/')}__merge_{uuid.uuid4().hex[:8]}"
    merged = upsert(target, rows.select(target.columns), keys, value, only_if_changed, policy=policy)
    layout(merged, "dt", keys).write.partitionBy("dt").parquet(staged)
    (spark.read.schema(target.schema).parquet(staged).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path))
    remove(spark, staged)


def next_load(spark: SparkSession, path: str) -> int:
    """The next number of a load into a dataset: one more than the largest taken, by an empty file per load.

    A file is made by one writer only, so two loads at a time get different numbers.
    """
    fs, folder = _folder(spark, f"{path.rstrip('/')}/_loads")
    fs.mkdirs(folder)
    n = max((int(s.getPath().getName()) for s in fs.listStatus(folder)), default=0) + 1
    while not _made(spark, f"{folder}/{n}"):
        n += 1
    return n


def _made(spark: SparkSession, path: str) -> bool:
    from py4j.protocol import Py4JJavaError

    fs, p = _folder(spark, path)
    if fs.exists(p):
        return False
    try:
        fs.create(p, False).close()
    except Py4JJavaError:  # another writer was first
        if fs.exists(p):
            return False
        raise
    return True


def write_staging(long_df: DataFrame, path: str, source: str, ts: str = "timestamp", seq: str | None = None) -> None:
    """Stage one source's rows, replacing its days.

    Rows carry the number of their load, and ``seq``, a number that orders the rows of one load, if there is one: of a
    key's copies the last of the last load counts, whatever its value and whenever its file was written or moved.
    """
    spark = long_df.sparkSession
    order = F.col(seq).cast("bigint") if seq else F.lit(None).cast("bigint")
    rows = (long_df.select(F.col(ts).cast("timestamp").alias("timestamp"), "deployment_fk", "metric_name", "value", order.alias("seq"))
            .filter(F.col("timestamp").isNotNull())
            .withColumns({"load": F.lit(next_load(spark, path)).cast("bigint"), "source": F.lit(source.lower()), "dt": F.to_date("timestamp")}))
    (layout(rows, "dt", ["deployment_fk", "metric_name"]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("source", "dt").parquet(path))


def drop_staging_day(spark: SparkSession, path: str, d, sources=("wu", "tsi")) -> None:
    """Remove a day's staging partitions after a merge; other days stay."""
    for s in sources:
        remove(spark, f"{path}/source={s.lower()}/dt={as_date(d).isoformat()}")


def staging_partitions(spark: SparkSession, path: str) -> DataFrame:
    """(source, dt) partitions present in the staging dataset."""
    fs, p = _folder(spark, path)
    sources = [s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("source=")] if fs.exists(p) else []
    found = [(s.removeprefix("source="), d) for s in sorted(sources) for d in days_present(spark, f"{path}/{s}")]
    return spark.createDataFrame(found, "source string, dt string").withColumn("dt", F.col("dt").cast("date"))


def append_run_log(df: DataFrame, path: str) -> None:
    """Append run or freshness rows; nested metadata is stored as JSON text."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType))]
    df.withColumns({c: F.to_json(c) for c in nested}).write.mode("append").parquet(path) if nested else \
        df.write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str, keep_last: int | None = None, ts: str = "timestamp", ties=()) -> None:
    """Write a JSON report.  With ``keep_last`` the file is a history: old and new rows, the latest kept."""
    if keep_last is None:
        df.write.mode("overwrite").json(path)
        return
    spark = df.sparkSession
    rows = df
    if exists(spark, path):
        rows = spark.read.schema(df.schema).json(path).unionByName(df)
    staged = f"{path.rstrip('/')}__new_{uuid.uuid4().hex[:8]}"
    # The cap is the feature: the history holds this many rows.
    rows.orderBy(F.desc(ts), *[F.desc(t) for t in ties]).limit(keep_last).write.json(staged)
    spark.read.schema(df.schema).json(staged).write.mode("overwrite").json(path)
    remove(spark, staged)


def write_current(df: DataFrame, path: str, key: str = "id", ts: str = "timestamp", ties=()) -> None:
    """Write a JSON report with one row per ``key``: rows of an earlier write stay until their key comes again.

    Of a key's copies in ``df`` the last by time, then by ``ties``, counts.
    """
    spark = df.sparkSession
    rows = df.withColumn("new", F.lit(1))
    if exists(spark, path):
        rows = rows.unionByName(spark.read.schema(df.schema).json(path).withColumn("new", F.lit(0)))
    order = F.struct("new", ts, *ties)
    staged = f"{path.rstrip('/')}__new_{uuid.uuid4().hex[:8]}"
    others = [c for c in df.columns if c != key]
    once = rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("row")).select(key, "row.*").select(df.columns)
    once.write.json(staged)
    spark.read.schema(df.schema).json(staged).write.mode("overwrite").json(path)
    remove(spark, staged)


def rewrite_canonical(spark: SparkSession, src: str, dst: str, schema) -> int:
    """Rewrite a Parquet folder to the canonical schema at a new path; raises when a row is lost."""
    raw = spark.read.parquet(src)
    conform(raw, schema).write.mode("overwrite").parquet(dst)
    # Both counts come from file footers; an accumulator could count a retried task twice.
    written, expected = spark.read.parquet(dst).count(), raw.count()
    if written != expected:
        raise RuntimeError(f"{written} of {expected} rows written to {dst}")
    return written


def ensure_table_columns(spark: SparkSession, table: str, schema) -> None:
    """Add missing columns to a catalog table."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    have = set(spark.table(table).columns)
    missing = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name not in have]
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(missing)})")


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> list[str]:
    """Temporary views over the frames."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def union_frames(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
