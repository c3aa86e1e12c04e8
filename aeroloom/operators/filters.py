"""Row predicates.  Day filters compare the bare column with literals so that they reach the scan."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from aeroloom import vocab
from aeroloom.functions.times import as_date, days_between


def _any(conds) -> Column:
    return reduce(or_, conds)


def _all(conds) -> Column:
    return reduce(and_, conds)


def on_day(df: DataFrame, ts: str, d) -> DataFrame:
    return df.filter(days_between(df, ts, d, d))


def between_days(df: DataFrame, ts: str, start, end) -> DataFrame:
    return df.filter(days_between(df, ts, start, end))


def utc_day(df: DataFrame, ts: str, d) -> DataFrame:
    """Half-open UTC day of a fetched payload."""
    return df.filter(days_between(df, ts, d, d))


def require(df: DataFrame, cols) -> DataFrame:
    return df.filter(_all([F.col(c).isNotNull() for c in cols]))


def drop_incomplete(df: DataFrame, cols) -> DataFrame:
    """Drop rows lacking a required value; an empty text counts as lacking."""
    kinds = dict(df.dtypes)
    return df.filter(_all([
        F.col(c).isNotNull() & (F.trim(F.col(c)) != "") if kinds[c] == "string" else F.col(c).isNotNull()
        for c in cols]))


def metric_in(df: DataFrame, metrics, col: str = "metric_name") -> DataFrame:
    return df.filter(F.col(col).isin(list(metrics)))


def id_prefix(df: DataFrame, prefixes=vocab.PRODUCTION_PREFIXES, col: str = "native_sensor_id") -> DataFrame:
    """Sensors whose id begins with one of the prefixes; production sensors by default."""
    return df.filter(_any([F.col(col).startswith(p) for p in prefixes]))


def in_set(df: DataFrame, other: DataFrame, key: str, negate: bool = False) -> DataFrame:
    """``key IN (other)`` as a semi join; ``NOT IN`` keeps its null rules.

    Spark's own null-aware anti join always broadcasts the set, whatever its size.  Here the set may be
    large: a plain anti join on equality, and a scalar that empties the result when the set holds a null.
    """
    if not negate:
        return df.join(other.select(key), key, "left_semi")
    facts = other.agg(F.struct(F.count_if(F.col(key).isNull()).alias("nulls"), F.count(F.lit(1)).alias("size"))).scalar()
    kept = df.join(other.select(key).filter(F.col(key).isNotNull()), key, "left_anti")
    return kept.filter((facts["nulls"] == 0) & (F.col(key).isNotNull() | (facts["size"] == 0)))


def has_samples(df: DataFrame) -> DataFrame:
    return df.filter(F.col("samples") > 0)


def active_or_unknown(df: DataFrame, col: str = "status") -> DataFrame:
    return df.filter((F.col(col) == "active") | F.col(col).isNull())


def plausible(df: DataFrame, bounds=None) -> DataFrame:
    """Keep rows whose bounded columns are all within range; a null is out of range."""
    bounds = vocab.PLAUSIBLE if bounds is None else bounds
    conds = [F.col(c).between(low, high) for c, (low, high) in bounds.items() if c in df.columns]
    return df.filter(_all(conds)) if conds else df


def at_latest(df: DataFrame, ts: str) -> DataFrame:
    """Rows at the latest ``ts`` of the table."""
    return df.filter(F.col(ts) == df.agg(F.max(ts)).scalar())


def having(grouped: DataFrame, cond: Column) -> DataFrame:
    """Predicate on aggregate aliases."""
    return grouped.filter(cond)


def where_case(df: DataFrame, expr: Column, value) -> DataFrame:
    """Predicate on the result of a CASE expression."""
    return df.filter(expr == F.lit(value))


_OPS = {">=": Column.__ge__, "<=": Column.__le__, ">": Column.__gt__, "<": Column.__lt__, "=": Column.__eq__}


def any_bound(df: DataFrame, rules, metric: str = "metric_name") -> DataFrame:
    """OR of (metric, column, comparison, bound) rules."""
    return df.filter(_any([(F.col(metric) == m) & _OPS[op](F.col(c), F.lit(bound)) for m, c, op, bound in rules]))


def split_test(df: DataFrame, prefixes=None, ids=None, col: str = "native_sensor_id") -> tuple[DataFrame, DataFrame]:
    """(test rows, production rows) by id prefix, or by a frame of test ids."""
    if ids is not None:
        return df.join(ids.select(col).distinct(), col, "left_semi"), df.join(ids.select(col).distinct(), col, "left_anti")
    test = _any([F.col(col).startswith(p) for p in (vocab.TEST_PREFIXES if prefixes is None else prefixes)])
    return df.filter(test), df.filter(~F.coalesce(test, F.lit(False)))


def epoch_on_day(df: DataFrame, col: str, d) -> DataFrame:
    """Integer epoch of unknown unit falling on day ``d`` as seconds or as milliseconds."""
    first = (as_date(d) - as_date("1970-01-01")).days * 86400
    last = first + 86400
    x = F.col(col)
    return df.filter(x.between(first, last - 1) | x.between(first * 1000, last * 1000 - 1))
