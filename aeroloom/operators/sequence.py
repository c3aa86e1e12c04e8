"""Ordered per-key computations that never put a whole key into one task.

A plain ``Window.partitionBy(sensor)`` sends every row of a sensor to one task, which fails when one sensor
holds a large share of all rows.  Here rows are dealt by ranges of (key, time), so that a key with many rows takes many
partitions.  Rows are counted per key and run, a run being up to `RUN_BITS` bits of rows of one partition; a row's number
is its place in its run plus the key's rows in earlier runs.  Frames that look back a fixed number of rows then run per block of rows, each block carrying the
rows just before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from aeroloom.session import materialize, saved

BLOCK_ROWS = 1_000_000
#: A run has at most 2 ** RUN_BITS rows: so many meet in one task, and a key of n rows has about n / 2 ** RUN_BITS runs.
RUN_BITS = 20


def number_rows(df: DataFrame, keys, order, seq: str = "seq", total: str = "key_rows", weight: str | None = None,
                run_bits: int = RUN_BITS) -> DataFrame:
    """Add ``seq`` (1-based position by ``order`` within the key) and ``total`` (rows of the key); nulls come first.

    With ``weight``, a column of whole numbers, ``seq`` is the weight of the rows before and ``total`` that of the key.
    Null keys are a key like any other.  Rows that are equal in keys and order stand together, in any order.  Works on
    a saved copy of the rows, dealt by ranges of (keys, order): positions must not change between two readings.
    """
    keys, order = list(keys), list(order)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    # An id is the partition in its upper bits and the row's place in the partition in the lower 33.
    placed = saved(dealt.withColumn("seq_at", F.monotonically_increasing_id()), "numbered")
    # Keys travel as one struct: it equals itself when a field is null.
    placed = placed.withColumns({"seq_key": F.struct(*keys), "seq_part": F.shiftright("seq_at", run_bits)})
    counted = F.count(F.lit(1)) if weight is None else F.sum(weight)
    runs = placed.groupBy("seq_key", "seq_part").agg(counted.alias("seq_n"), F.min("seq_at").alias("seq_from"))
    key = Window.partitionBy("seq_key")
    earlier = (Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("seq_n").over(key.orderBy("seq_part").rowsBetween(*earlier)), F.lit(0))
    runs = runs.select("seq_key", "seq_part", "seq_from", before.alias("seq_before"), F.sum("seq_n").over(key).alias(total))
    inside = F.col("seq_at") - F.col("seq_from") + 1
    if weight is not None:
        part = Window.partitionBy("seq_key", "seq_part").orderBy("seq_at").rowsBetween(*earlier)
        inside = F.coalesce(F.sum(weight).over(part), F.lit(0))
    return placed.join(runs, ["seq_key", "seq_part"]).withColumn(seq, F.col("seq_before") + inside).select(*df.columns, total, seq)


def sequence_rows(df: DataFrame, keys, ts: str, ties=(), run_bits: int = RUN_BITS) -> DataFrame:
    """Add ``seq`` (1-based position by ``ts`` then ``ties`` within the key) and ``key_rows`` (rows of the key).

    Equal (ts, ties) rows are numbered in any order.  Rows without a time stay: they have no ``seq`` and are not counted.
    """
    timeless = df.filter(F.col(ts).isNull()).withColumns({"key_rows": F.lit(None).cast("bigint"), "seq": F.lit(None).cast("bigint")})
    return number_rows(df.filter(F.col(ts).isNotNull()), keys, [ts, *ties], run_bits=run_bits).unionByName(timeless)


def lookback(df: DataFrame, keys, halo: int, columns, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add window columns that look back at most ``halo`` rows of ``seq`` order.

    ``columns`` maps each new name to a function of the window (partitioned and ordered, without frame).  Rows without a
    ``seq`` get nulls.
    """
    keys = list(keys)
    timeless, df = df.filter(F.col("seq").isNull()), df.filter(F.col("seq").isNotNull())
    block_rows = max(block_rows, halo)
    zero = F.col("seq") - 1
    block = F.floor(zero / block_rows)
    home = F.struct(block.alias("block"), F.lit(False).alias("copy"))
    ahead = F.struct((block + 1).alias("block"), F.lit(True).alias("copy"))
    carried = (zero % block_rows >= block_rows - halo) & (F.col("seq") < F.col("key_rows"))
    placed = (df.withColumn("at", F.explode(F.when(carried, F.array(home, ahead)).otherwise(F.array(home))))
              .select(*df.columns, "at.block", "at.copy"))
    window = Window.partitionBy(*keys, "block").orderBy("seq")
    made = (placed.repartition(*keys, "block").withColumns({name: make(window) for name, make in columns.items()})
            .filter(~F.col("copy")).drop("block", "copy"))
    types = {f.name: f.dataType for f in made.schema}
    return made.unionByName(timeless.withColumns({name: F.lit(None).cast(types[name]) for name in columns}))


def rank_within(df: DataFrame, keys, value: str, name: str = "rank", descending: bool = True, run_bits: int = RUN_BITS) -> DataFrame:
    """RANK() of ``value`` within the key, ties sharing a rank, nulls last.

    Distinct values are counted map-side and their counts summed in order over ranges; rows then take the rank of their
    value.  The input is checkpointed first: counts and rows must see bit-identical values, and float sums may
    differ between two runs of one plan.
    """
    keys = list(keys)
    fixed = materialize(df)
    counts = fixed.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("seq_rows"))
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    ranks = number_rows(counts, keys, [order], "seq", "seq_total", "seq_rows", run_bits)
    ranks = ranks.select(F.struct(*keys, value).alias("seq_key"), (F.col("seq") + 1).alias(name))
    return fixed.withColumn("seq_key", F.struct(*keys, value)).join(ranks, "seq_key").select(*df.columns, name)


def exact_quantile(df: DataFrame, keys, value: str, q: float, name: str = "quantile", run_bits: int = RUN_BITS) -> DataFrame:
    """Exact linear-interpolated quantile per key.

    Distinct values are counted map-side and their counts summed in order over ranges, which tells the values at the
    wanted positions.  Spark's ``percentile`` would gather every distinct value of a key in one task.
    """
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = number_rows(counts, keys, ["v"], "start", "rows", "n", run_bits)
    pos = (F.col("rows") - 1) * F.lit(float(q))

    def at(place: Column) -> Column:
        return F.max(F.when((place >= F.col("start")) & (place < F.col("start") + F.col("n")), F.col("v")))

    lower, upper = at(F.floor(pos)), at(F.ceil(pos))
    return placed.groupBy(*keys).agg((lower + (upper - lower) * (F.max(pos) - F.floor(F.max(pos)))).alias(name))
