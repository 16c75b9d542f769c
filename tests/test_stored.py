"""Stored results: buckets, numbering in one evaluation, nested documents, the
batch application."""

import os

import pytest
from pyspark.sql import functions as F

from tickflow.operators import windows as W
from tickflow.operators.metrics import import_nested, nested_rejects
from tickflow.operators.ordinal import ordinal
from tickflow.operators.reconcile import compare_windows
from tickflow.plans import batch, fixtures as X
from tickflow.plans import streams as S
from tickflow.plans.batch_run import run_application, run_batch, timed_write
from tickflow.session import drop_scratch, release_scratch, shared_root, temporary_scratch
from tickflow.sources.tables import spread
from tickflow.streaming.sinks import store_bucketed

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_windows_join_without_a_shuffle(spark, no_broadcast, tmp_root):
    w = W.windowed(X.prices(spark, SF))
    a = store_bucketed(w, "bucket_test_a", f"{tmp_root}/a", W.WINDOW_KEYS, 4)
    b = store_bucketed(w, "bucket_test_b", f"{tmp_root}/b", W.WINDOW_KEYS, 4)
    c = compare_windows(a, b)
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert c.count() == w.count() and c.filter("avg_price_diff <> 0 OR volume_diff <> 0").count() == 0
    files = [f for f in os.listdir(f"{tmp_root}/a".replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) <= 4


def test_numbering_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(v):
        seen.add(1)
        return v
    df = spark.range(0, 3000, 1, 3).select(F.udf(look, "long")("id").alias("o"), (F.col("id") % 3).alias("g"))
    got = ordinal(df, ["g"], ["o"])
    assert seen.value == 3000
    assert got.count() == 3000 and got.filter("idx <> (o - g) / 3").count() == 0
    assert seen.value == 3000


def test_numbering_removes_its_first_copy_and_ends_with_the_application(spark):
    home = f"{shared_root(spark)}/tickflow".replace("file:", "")

    def there():
        return {d for d in os.listdir(home) if d.startswith("ordinal")} if os.path.isdir(home) else set()
    before = there()
    got = ordinal(spark.range(50).toDF("o"), [], ["o"])
    assert got.count() == 50
    new = there() - before
    assert len(new) == 1 and not any(d.startswith("ordinal-input") for d in new)


def test_temporary_locations_are_released(spark):
    from tickflow import session
    app = spark.sparkContext.applicationId
    kept = session._TEMPORARY.pop(app, None)
    try:
        path = temporary_scratch(spark, "short")
        spark.range(3).write.parquet(path)
        release_scratch(spark)
        assert not os.path.exists(path.replace("file:", ""))
        release_scratch(spark)  # nothing left: nothing happens
    finally:
        if kept:
            session._TEMPORARY[app] = kept


def test_previous_values_leave_a_temporary_copy_only(spark):
    from tickflow import session
    before = set(session._TEMPORARY.get(spark.sparkContext.applicationId, (None, []))[1])
    assert batch.market_trend(spark, SF).count() > 0
    new = set(session._TEMPORARY[spark.sparkContext.applicationId][1]) - before
    assert len(new) == 1 and "/previous-" in new.pop()


DOC = ('{"streaming":{"latency":[1.0,2.0,4],"throughput":[8.0],"errors":[0,1],"resource_usage":[{"cpu_percent":1.5}],'
       '"data_points":[{"batch_size":8},{"total_records":9,"batch_size":null}]},"batch":{"latency":["x"],"errors":[3]},"other":{}}')


def test_nested_lists_of_unequal_length(spark):
    df = spark.createDataFrame([(1, DOC), (2, "{}"), (3, "oops"), (4, None), (5, "[1]"), (6, "null")], "doc_id int, document string")
    rows = import_nested(df, keep=("doc_id",)).orderBy("mode", "pos").collect()
    assert [(r.doc_id, r.mode, r.pos, r.rows, r.processing_time, r.throughput, r.error_count, r.cpu_percent) for r in rows] == [
        (1, "batch", 0, None, None, None, 3, None),
        (1, "streaming", 0, 8.0, 1.0, 8.0, 0, 1.5), (1, "streaming", 1, 9.0, 2.0, None, 1, None),
        (1, "streaming", 2, None, 4.0, None, None, None)]
    assert sorted((r.doc_id, r.raw) for r in nested_rejects(df, keep=("doc_id",)).collect()) == [
        (3, "oops"), (4, None), (5, "[1]"), (6, "null")]


def test_nested_documents_are_parsed_once(spark):
    df = spark.createDataFrame([(1, DOC)], "doc_id int, document string")
    plan = import_nested(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") == 1 or plan.count("parseJson") == 1


def test_few_splits_are_spread_and_many_left_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == cores
    many = spark.range(0, 100, 1, cores + 3)
    assert spread(many) is many


def test_batch_application_ends_with_report_and_consistency(spark, tmp_root):
    prices, market = X.prices(spark, SF), X.market_rows(spark, SF)
    log = W.windowed(prices).withColumn("batch_id", F.lit(0))
    out = run_application(spark, prices, market, log, tmp_root)
    assert {r.query: r.error_count for r in out["metrics"].collect()} == {
        "price_analysis": 0, "market_analysis": 0, "comparison": 0}
    by_mode = {r.mode: r for r in out["report"].collect()}
    assert by_mode["batch"].avg_latency > 0 and by_mode["streaming"].avg_latency == 0
    assert out["consistency"].first().batch_records == prices.count()
    assert spark.read.parquet(f"{tmp_root}/comparison").count() == log.count()


def test_a_failed_analysis_is_an_error_and_the_others_run(spark):
    prices, market = X.prices(spark, SF), X.market_rows(spark, SF)
    log = W.windowed(prices)
    with pytest.warns(UserWarning, match="market_analysis failed"):
        m = run_batch(spark, prices, market.drop("volume_change_24h"), log)
    assert {r.query: (r.error_count, r.rows > 0) for r in m.collect()} == {
        "price_analysis": (0, True), "market_analysis": (1, False), "comparison": (0, True)}


def test_a_failure_while_running_is_an_error(spark):
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("v"))
    with pytest.warns(UserWarning, match="broken"):
        r = timed_write("broken", 0, bad, lambda df: df, None).first()
    assert (r.error_count, r.rows) == (1, 0.0)


def test_overflowing_rows_are_rejected_not_lost(spark):
    got = batch.sink_overflow_prices(spark, SF)
    assert got.count() == 1000 and 0 < got.filter("is_reject").count() <= 77
    assert got.filter("is_reject AND price_usd IS NOT NULL").count() == 0
