import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickflow.operators.windows import null_time_count, require_columns, windowed


def _prices(spark, rows):
    return spark.createDataFrame(rows, "coin_id string, price_usd double, volume_24h double, timestamp timestamp_ntz")


def _starts(df):
    return sorted(r.window_start.strftime("%H:%M") for r in df.collect())


def test_window_start_inclusive(spark):
    df = _prices(spark, [("a", 1.0, 1.0, dt.datetime(2024, 1, 1, 0, 15, 0))])
    assert _starts(windowed(df)) == ["00:05", "00:10", "00:15"]


def test_window_end_exclusive(spark):
    df = _prices(spark, [("a", 1.0, 1.0, dt.datetime(2024, 1, 1, 0, 14, 59))])
    assert _starts(windowed(df)) == ["00:00", "00:05", "00:10"]


def test_window_values(spark):
    t = dt.datetime(2024, 1, 1, 0, 1, 0)
    df = _prices(spark, [("a", 1.0, 10.0, t), ("a", 3.0, 5.0, t + dt.timedelta(minutes=1)), ("b", 7.0, 1.0, t)])
    rows = {(r.window_start.strftime("%H:%M"), r.coin_id): r for r in windowed(df).collect()}
    r = rows[("00:00", "a")]
    assert (r.avg_price, r.min_price, r.max_price, r.total_volume) == (2.0, 1.0, 3.0, 15.0)
    assert r.window_end - r.window_start == dt.timedelta(minutes=15)
    assert len(rows) == 6


def test_null_time_dropped_and_counted(spark):
    df = _prices(spark, [("a", 1.0, 1.0, None), ("a", 2.0, 1.0, dt.datetime(2024, 1, 1))])
    assert windowed(df).count() == 3
    assert null_time_count(df).first()[0] == 1


def test_guard_missing_column(spark):
    df = spark.createDataFrame([("a", 1.0)], "coin_id string, price_usd double")
    with pytest.raises(ValueError):
        require_columns(df, "timestamp")
    with pytest.raises(ValueError):
        windowed(df)


def test_window_plan_is_partial_then_final(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_type").alias("coin_id"), F.col("value").alias("price_usd"),
        F.col("value").alias("volume_24h"), F.col("ts").alias("timestamp"))
    plan = windowed(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and plan.count("HashAggregate") >= 2


from hypothesis import given, settings, strategies as st


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=3 * 24 * 3600), min_size=1, max_size=40))
def test_each_row_in_three_windows_containing_it(spark, seconds):
    base = dt.datetime(2024, 1, 1)
    rows = [("a", 1.0, 1.0, base + dt.timedelta(seconds=s)) for s in seconds]
    df = _prices(spark, rows).withColumn("rid", F.monotonically_increasing_id())
    win = df.select("rid", "timestamp", F.window("timestamp", "15 minutes", "5 minutes").alias("w"))
    got = win.groupBy("rid").agg(F.count("*").alias("n"),
                                 F.min(F.col("w.start") <= F.col("timestamp")).alias("start_ok"),
                                 F.min(F.col("timestamp") < F.col("w.end")).alias("end_ok")).collect()
    assert len(got) == len(rows) and all(r.n == 3 and r.start_ok and r.end_ok for r in got)
    # the aggregate equals a brute-force count per window start
    expect = {}
    for s in seconds:
        b = s - s % 300
        for k in range(3):
            expect[base + dt.timedelta(seconds=b - 300 * k)] = expect.get(base + dt.timedelta(seconds=b - 300 * k), 0) + 1
    agg = windowed(_prices(spark, rows), extra=[F.count("*").alias("n")]).collect()
    assert {r.window_start: r.n for r in agg} == expect
