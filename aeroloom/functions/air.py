"""Air-quality classifications as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from aeroloom.vocab import AQI_BREAKPOINTS, AQI_BUCKETS, HEALTH_CATEGORIES


def _ladder(col: Column, steps) -> Column:
    """Name of the first step whose inclusive upper bound holds ``col``; null stays null."""
    out = None
    for bound, name in steps:
        cond = col.isNotNull() if bound is None else col <= F.lit(float(bound))
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def health_category(col: Column) -> Column:
    return _ladder(col, HEALTH_CATEGORIES)


def aqi_bucket(col: Column) -> Column:
    return _ladder(col, AQI_BUCKETS)


def aqi(col: Column, parity: bool = False) -> Column:
    """PM2.5 -> AQI by linear breakpoints, rounded half to even; 500 above the table.

    The table has gaps (12.0..12.1 and so on).  By default the concentration is truncated to one
    decimal first, as the index is defined; ``parity=True`` looks the raw value up, so a value in a
    gap, or below zero, gives 500.
    """
    x = col if parity else F.floor(F.round(col * 10, 6)) / 10.0
    out = None
    for low, high, index_low, index_high in AQI_BREAKPOINTS:
        slope = (index_high - index_low) / (high - low)
        value = F.bround(F.lit(slope) * (x - F.lit(low)) + F.lit(float(index_low)), 0).cast("int")
        cond = (x >= F.lit(low)) & (x <= F.lit(high))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if not parity:
        out = out.when(x < 0, F.lit(0))
    return out.when(col.isNotNull(), F.lit(500))


def confidence(hours_ahead: Column) -> Column:
    return F.when(hours_ahead <= 6, "high").when(hours_ahead <= 24, "medium").otherwise("low")


def quality_score(samples: Column) -> Column:
    return F.when(samples >= 20, "High").when(samples >= 10, "Medium").otherwise("Low")


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def geo_point(lat: Column, lon: Column) -> Column:
    """Point as ``struct<longitude, latitude>``; null when either coordinate is."""
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lon.alias("longitude"), lat.alias("latitude")))


def row_id(*cols, algo: str = "xxhash64") -> Column:
    """Fingerprint of the given columns joined by ``|``."""
    text = F.concat_ws("|", *[c.cast("string") if isinstance(c, Column) else F.col(c).cast("string") for c in cols])
    return F.sha2(text, 256) if algo == "sha2" else F.xxhash64(text)
