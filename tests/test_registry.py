"""Registered queries: structure, and a sample of them against their oracle at the smallest scale."""

import pytest

import __spark_entry__ as entry
from verification import catalog as checked
from verification.run import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
SAMPLE = ["a01_hourly_rollup", "a02_daily_from_wide", "a04_resample_tsi", "a20_metric_stats", "c14_canonical_location", "f06_not_in_set",
          "j05_map_latest_wins", "k03_replace_window", "k05_upsert", "m03_apply_cooldown", "n05_normalize_time_materialize", "n08_flatten_units",
          "q07_rollup_ratio", "r03_stream_hourly", "s01_scan_landing", "w03_rank_by_metric", "w06_missing_slots"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    # Trees and the full linear model; each has a query on one feature that is compared.
    assert {n for n in checked.QUERIES if n not in checked.ORACLES} == {"m08_m09_train_and_evaluate", "m10_save_model", "m11_forecast", "m12_forecast_summary"}


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.count() == 456 and "avg_value" in df.columns


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).fetchdf()) == ""
