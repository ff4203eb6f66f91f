"""Every registered query against its DuckDB oracle (row count, column names,
values), at sf0.001 for speed; the driver repeats this at sf0.01."""

import pytest

import __spark_entry__ as entry_mod
from stratus.plans.catalog import QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["location", "rows", "avg_humidity", "total_rain_mm"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_mod.queries()) and set(QUERIES) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems = compare(spark, con, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name], SF)
    assert not problems, problems


def test_reply_parse_without_adaptive_execution(spark):
    """Static planning broadcasts the reply lines; the per-line CSV parse must
    not allocate megabytes per line (this ran out of heap before)."""
    sf = "/root/testdata/sf0.01"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        problems = compare(spark, duck(sf), "raw_reply_parse", entry_mod.queries()["raw_reply_parse"],
                           entry_mod.oracle_sql()["raw_reply_parse"], sf)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert not problems, problems
