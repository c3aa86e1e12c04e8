"""Registry of checked queries: name -> (Spark query, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verification.feeds import Feeds, oracle, rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def add(name: str, build: Callable[[Feeds], DataFrame], sql: str | None = None, doubles: str = "") -> None:
    """Register a query over the feeds; the doubles of its result are rounded last."""
    if name in QUERIES:
        raise ValueError(f"{name} registered twice")
    QUERIES[name] = lambda spark, sf_dir: rounded(build(Feeds(spark, sf_dir)))
    if sql is not None:
        ORACLES[name] = oracle(sql, doubles)
