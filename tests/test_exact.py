"""Exact sums and pane aggregation."""

import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tickflow.functions import exact
from tickflow.operators.market import avg_changes
from tickflow.operators.reconcile import consistency
from tickflow.operators.windows import pane_windowed, windowed


def _sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    return exact.split(df, v=F.col("v")).agg(*exact.sums("v")).select(exact.total("v"), exact.mean("v")).first()


@pytest.mark.parametrize("values", [
    [0.1] * 10, [1e14, 0.1, -1e14], [-0.1, -0.7, 1e-9], [3.0], [-5.5, 5.5], [2.0 ** 47, 2.0 ** -20, -(2.0 ** 46)],
    [random.Random(1).uniform(-1e6, 1e6) for _ in range(500)], [random.Random(2).uniform(0, 1e13) for _ in range(3000)],
    [random.Random(3).expovariate(1) for _ in range(300)], [2.0 ** 52 / 16, 0.5, 2.0 ** -30] * 40])
def test_total_is_the_rounded_exact_sum(spark, values):
    want = sum(map(Fraction, values))
    total, mean = _sum(spark, values)
    assert total == float(want) and mean == float(want) / len(values)


def test_nulls_large_and_special_values(spark):
    assert tuple(_sum(spark, [None, None])) == (None, None)
    assert tuple(_sum(spark, [None, 1.5])) == (1.5, 1.5)
    assert _sum(spark, [1e300, 2.0])[0] == 1e300
    assert _sum(spark, [math.inf, 2.0])[0] == math.inf
    assert math.isnan(_sum(spark, [math.nan, 2.0])[0])


def _prices(spark, n=4000):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        # one pane of one coin holds half of all rows
        t = dt.datetime(2024, 1, 1, 3, 1) if i % 2 else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(86400))
        rows.append(("a" if i % 2 else rnd.choice("abc"), rnd.uniform(0, 1e5) if i % 50 else None, rnd.uniform(0, 1e9), t))
    return spark.createDataFrame(rows, "coin_id string, price_usd double, volume_24h double, timestamp timestamp_ntz")


def test_same_bits_at_any_partitioning(spark):
    df = _prices(spark).persist()
    want = None
    for n in (1, 7, 64):
        got = {tuple(r) for r in pane_windowed(df.repartition(n)).collect()}
        want = want or got
        assert got == want
    market = df.select("coin_id", F.col("price_usd").alias("price_change_24h"), F.col("price_usd").alias("market_cap_change_24h"),
                       F.col("volume_24h").alias("volume_change_24h"))
    assert len({tuple(map(tuple, avg_changes(market.repartition(n)).orderBy("coin_id").collect())) for n in (1, 7, 64)}) == 1
    log = windowed(df)
    assert len({tuple(consistency(log, df.repartition(n)).first())[0] for n in (1, 7, 64)}) == 1
    df.unpersist()


def test_panes_give_the_windows_of_rows(spark):
    df = _prices(spark, 600)
    exp = {(r.window_start, r.coin_id): r for r in windowed(df).collect()}
    got = {(r.window_start, r.coin_id): r for r in pane_windowed(df).collect()}
    assert got.keys() == exp.keys()
    for k, r in got.items():
        assert r.window_end == exp[k].window_end
        assert (r.min_price, r.max_price) == (exp[k].min_price, exp[k].max_price)
        assert r.avg_price == pytest.approx(exp[k].avg_price, rel=1e-12) if r.avg_price is not None else exp[k].avg_price is None
        assert r.total_volume == pytest.approx(exp[k].total_volume, rel=1e-12)


def _tree(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_multiplied_before_they_are_aggregated(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_type").alias("coin_id"), F.col("value").alias("price_usd"),
        F.col("value").alias("volume_24h"), F.col("ts").alias("timestamp"))
    lines = _tree(pane_windowed(df)).split("\n")
    expand = [i for i, x in enumerate(lines) if "Expand" in x or "Generate" in x]
    aggregates = [i for i, x in enumerate(lines) if "HashAggregate" in x]
    # a plan reads from the last line up: both aggregates of the panes lie below the windows
    assert len(expand) == 1 and sum(a > expand[0] for a in aggregates) == 2 and "SortAggregate" not in _tree(pane_windowed(df))


def test_a_hot_pane_is_one_row_a_task_before_the_shuffle(spark):
    """Rows that leave the map side: one for each task, pane and coin, however many rows the pane has."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.lit("a").alias("coin_id"), F.rand(1).alias("price_usd"), F.lit(1.0).alias("volume_24h"),
        F.lit(dt.datetime(2024, 1, 1, 3, 1)).cast("timestamp_ntz").alias("timestamp"))
    out = pane_windowed(df)
    rows = out.collect()
    assert len(rows) == 3 and {r.total_volume for r in rows} == {200_000.0}
    plan = out._jdf.queryExecution().executedPlan()
    assert "partial_sum" in plan.toString()


def test_windows_must_be_whole_panes(spark):
    with pytest.raises(ValueError):
        pane_windowed(_prices(spark, 2), duration="7 minutes")
    with pytest.raises(ValueError):
        pane_windowed(_prices(spark, 2), slide="a while")
