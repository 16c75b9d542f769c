"""Every query of the core against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck
from tickflow.plans import catalog

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], SQL.get(name), SF)
    assert r["status"] == "MATCH", r
    assert r["spark_rows"] > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "coin_id", "avg_price", "min_price", "max_price",
                          "total_volume"]


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_stays_in_the_jvm(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PYTHON_NODES), plan


TZ_QUERIES = ["price_window_agg", "decode_prices", "decode_market", "encode_price_messages", "market_trend",
              "stream_raw_prices", "stream_price_windows_latest", "stream_price_windows_watermark"]


@pytest.mark.parametrize("name", TZ_QUERIES)
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, con, name, E.queries()[name], SQL[name], SF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["status"] == "MATCH", r
