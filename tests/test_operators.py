import decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickflow.functions.arith import percent_diff, throughput
from tickflow.operators import market as MK
from tickflow.operators.metrics import import_nested, load_metrics, report
from tickflow.operators.ordinal import ordinal
from tickflow.operators.reconcile import compare_windows, consistency
from tickflow.operators.typed_sink import to_sink_types


def test_decimal_overflow_is_reject_and_rounding_half_up(spark):
    df = spark.createDataFrame([(1e13,), (0.000000005,), (None,)], "p double")
    rows = to_sink_types(df, {"p": (20, 8)}).collect()
    assert rows[0].p is None and rows[0].is_reject
    assert rows[1].p == decimal.Decimal("0.00000001") and not rows[1].is_reject
    assert rows[2].p is None and not rows[2].is_reject


def test_percent_diff_zero_denominator_is_null(spark):
    r = spark.range(1).select(percent_diff(F.lit(1.0), F.lit(0.0)).alias("a"),
                              percent_diff(F.lit(3.0), F.lit(2.0)).alias("b")).first()
    assert r.a is None and r.b == 50.0


def test_throughput_zero_time(spark):
    r = spark.range(1).select(throughput(F.lit(8), F.lit(0.0)).alias("t")).first()
    assert r.t == 0.0


def test_report_empty_mode_has_zeros(spark):
    m = load_metrics(spark, None)
    rows = {r.mode: r for r in report(m).collect()}
    assert set(rows) == {"streaming", "batch"}
    assert rows["batch"].avg_latency == 0.0 and rows["batch"].total_errors == 0


def test_load_metrics_missing_path_is_empty(spark, tmp_root):
    assert load_metrics(spark, tmp_root + "/nothing").count() == 0


def test_report_values(spark):
    from tickflow.schemas import METRICS_RECORD
    m = spark.createDataFrame([("streaming", 0, "q", 0, 8.0, 2.0, 1, 0.0, 3.0, 0.1),
                               ("streaming", 1, "q", 1, 8.0, 0.0, 0, 0.0, 1.0, 0.1)], METRICS_RECORD)
    r = {x.mode: x for x in report(m).collect()}["streaming"]
    assert r.avg_latency == 1.0 and r.avg_throughput == 2.0 and r.total_errors == 1 and r.avg_memory_usage == 2.0


def test_nested_import(spark):
    doc = ('{"streaming":{"latency":[1.0,2.0],"throughput":[8.0,4.0],"errors":[0,1],'
           '"resource_usage":[{"cpu_percent":0.0,"memory_percent":3.0,"memory_used_gb":0.1},'
           '{"cpu_percent":0.0,"memory_percent":3.5,"memory_used_gb":0.2}],'
           '"data_points":[{"batch_size":8,"processing_time":1.0,"error_count":0},'
           '{"batch_size":8,"processing_time":2.0,"error_count":1}]},'
           '"batch":{"latency":[],"throughput":[],"errors":[],"resource_usage":[],"data_points":[]}}')
    df = spark.createDataFrame([(1, doc)], "doc_id int, document string")
    rows = import_nested(df, keep=("doc_id",)).orderBy("pos").collect()
    assert [(r.mode, r.pos, r.rows, r.error_count) for r in rows] == [("streaming", 0, 8.0, 0), ("streaming", 1, 8.0, 1)]


def test_ordinal_matches_row_number_on_skewed_groups(spark):
    # one group holds most rows
    df = spark.range(0, 5000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"),
                                     (F.col("id") * 7 % 5003).alias("o"))
    got = ordinal(df, ["g"], ["o"], partitions=7)
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    j = got.join(ref, ["g", "o"])
    assert j.count() == 5000 and j.filter("idx <> ref").count() == 0


def test_tracked_list_and_table(spark):
    df = spark.createDataFrame([("bitcoin", 1.0), ("foo", 2.0), ("solana", 3.0)], "coin_id string, m double")
    assert {r.coin_id for r in MK.tracked(df).collect()} == {"bitcoin", "solana"}
    t = spark.createDataFrame([("foo",)], "coin_id string")
    assert [r.coin_id for r in MK.tracked(df, t).collect()] == ["foo"]


def test_top_by_market_cap_ties(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 9.0), ("d", 1.0)], "coin_id string, market_cap double")
    assert [r.coin_id for r in MK.top_by_market_cap(df, 3).collect()] == ["c", "a", "b"]


def test_compare_and_consistency(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    cols = "window_start timestamp_ntz, window_end timestamp_ntz, coin_id string, avg_price double, " \
           "min_price double, max_price double, total_volume double"
    e = t + dt.timedelta(minutes=15)
    s = spark.createDataFrame([(t, e, "a", 2.0, 1.0, 3.0, 10.0), (t, e, "a", 2.5, 1.0, 4.0, 12.0),
                               (t, e, "z", 1.0, 1.0, 1.0, 1.0)], cols)
    b = spark.createDataFrame([(t, e, "a", 2.5, 1.0, 4.0, 12.0)], cols)
    diffs = sorted(r.avg_price_diff for r in compare_windows(s, b).collect())
    assert diffs == [-0.5, 0.0]                  # z has no batch window: dropped
    p = spark.createDataFrame([(2.0, 4.0), (2.0, 6.0)], "price_usd double, volume_24h double")
    c = consistency(b, p).first()
    assert c.price_difference_percent == 25.0 and c.streaming_records == 1 and c.batch_records == 2


def test_read_table_and_jdbc_options(spark):
    from tickflow.sources.tables import jdbc_options, read_table
    df = read_table(spark, "parquet", "/root/testdata/sf0.001/events.parquet")
    assert df.count() == 1000
    o = jdbc_options("jdbc:x", "price_rows", "id", 0, 100, 8, fetchsize=1000)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == 8 and o["dbtable"] == "price_rows"


def test_two_places(spark):
    from tickflow.functions.display import formatted
    r = formatted(spark.createDataFrame([(1.005, 2.0)], "a double, b double"), ["a", "b"]).first()
    assert r.b == "2.00" and r.a in ("1.00", "1.01")


def test_previous_value_matches_lag_across_buckets(spark):
    import datetime as dt
    from tickflow.operators.extensions import previous_value
    base = dt.datetime(2024, 1, 1)
    rows = [("hot" if i % 4 else "cold", base + dt.timedelta(minutes=5 * (i * 37 % 2000)), float(i))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "coin_id string, window_start timestamp_ntz, avg_price double") \
              .dropDuplicates(["coin_id", "window_start"])
    got = previous_value(df, "coin_id", "window_start", "avg_price", "prev")
    ref = df.withColumn("ref", F.lag("avg_price").over(Window.partitionBy("coin_id").orderBy("window_start")))
    j = got.join(ref, ["coin_id", "window_start"])
    assert j.count() == df.count()
    assert j.filter(~F.col("prev").eqNullSafe(F.col("ref"))).count() == 0


def test_shared_root_reads_session_setting(spark):
    from tickflow.session import scratch_path, shared_root
    root = shared_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/tickflow/x-")


def test_show_results_prints_bounded_rows(spark, capsys):
    from tickflow.functions.display import show_results
    show_results(spark.range(100), n=3)
    out = capsys.readouterr().out
    assert "only showing top 3 rows" in out


def test_ordinal_keeps_null_groups_at_any_partition_count(spark):
    df = spark.range(0, 1000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    for n in (1, 4, 64):
        got = ordinal(df, ["g"], ["o"], partitions=n)
        j = got.join(ref.select("o", "ref"), "o")
        assert j.count() == 1000 and j.filter("idx <> ref").count() == 0


def test_ordinal_without_groups_and_empty(spark):
    got = ordinal(spark.range(100).select((F.lit(99) - F.col("id")).alias("o")), [], ["o"], partitions=3)
    assert got.count() == 100 and got.filter("idx <> o").count() == 0
    assert ordinal(spark.range(0).withColumn("g", F.lit(1)), ["g"], ["id"]).count() == 0


def test_previous_value_with_null_keys_is_lag(spark):
    import datetime as dt
    from tickflow.operators.extensions import previous_value
    t = dt.datetime(2024, 1, 1)
    rows = [(None, t, 1.0), (None, t + dt.timedelta(days=1), 2.0), ("a", t, 3.0), (None, None, 4.0)]
    df = spark.createDataFrame(rows, "coin_id string, window_start timestamp_ntz, v double")
    ref = df.withColumn("ref", F.lag("v").over(Window.partitionBy("coin_id").orderBy("window_start")))
    got = previous_value(df, "coin_id", "window_start", "v", "prev").join(ref.select("v", "ref"), "v")
    assert got.count() == 4 and got.filter(~F.col("prev").eqNullSafe(F.col("ref"))).count() == 0


def test_shared_root_needs_a_shared_folder_off_local():
    from types import SimpleNamespace
    import pytest
    from tickflow.session import shared_root
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(SimpleNamespace(sparkContext=sc, conf=conf))


def test_drop_scratch_removes_only_own_locations(spark):
    import os
    import pytest
    from tickflow.session import drop_scratch, scratch_path
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert not os.path.exists(path.replace("file:", ""))
    with pytest.raises(ValueError):
        drop_scratch(spark, "/tmp/elsewhere")


def test_windows_by_arrival_time(spark):
    from tickflow.functions.timecols import arrival_time
    from tickflow.operators.windows import windowed
    df = spark.createDataFrame([("a", 1.0, 2.0, 1_700_000_000_123)], "coin_id string, price_usd double, "
                               "volume_24h double, ingest_ms long")
    got = windowed(df.withColumn("arrived", arrival_time()), time_col="arrived")
    assert got.count() == 3


def test_compare_needs_two_exchanges_and_latest_no_sort_aggregate(spark):
    from tickflow.operators.reconcile import compare_windows
    from tickflow.operators.windows import windowed
    from tickflow.streaming.queries import latest_windows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = spark.createDataFrame([], "window_start timestamp_ntz, window_end timestamp_ntz, coin_id string, "
                                    "avg_price decimal(20,8), min_price decimal(20,8), max_price decimal(20,8), "
                                    "total_volume decimal(20,2), batch_id long")
        prices = spark.createDataFrame([], "coin_id string, price_usd double, volume_24h double, "
                                       "timestamp timestamp_ntz")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.optimizer.excludedRules",
                       "org.apache.spark.sql.catalyst.optimizer.ConvertToLocalRelation,"
                       "org.apache.spark.sql.catalyst.optimizer.PropagateEmptyRelation")
        plan = compare_windows(latest_windows(log), windowed(prices))._jdf.queryExecution().executedPlan().toString()
    finally:
        for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.optimizer.excludedRules"):
            spark.conf.unset(c)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in plan


def test_market_trend_labels(spark):
    import datetime as dt
    from tickflow.operators.extensions import market_trend
    t = dt.datetime(2024, 1, 1)
    m = dt.timedelta(minutes=5)
    rows = [(t, "a", 10.0), (t + m, "a", 12.5), (t + 2 * m, "a", 12.5), (t + 3 * m, "a", 10.0),
            (t + dt.timedelta(days=2), "a", 11.0), (t, "b", 1.0)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, coin_id string, avg_price double")
    got = {(r.coin_id, r.window_start): r for r in market_trend(df).collect()}
    assert [got[("a", t + k * m)].trend for k in range(4)] == ["new", "up", "flat", "down"]
    assert got[("a", t + m)].pct_change == 25.0 and got[("a", t + 3 * m)].pct_change == -20.0
    later = got[("a", t + dt.timedelta(days=2))]       # previous window is two days back, in another bucket
    assert later.prev_avg_price == 10.0 and later.trend == "up"
    assert got[("b", t)].trend == "new" and got[("b", t)].prev_avg_price is None
