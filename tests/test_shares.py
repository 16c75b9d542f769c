"""Replays that grow with their input only: shares without a sort of the
table, state partitions, files by date; rounding without text."""

import os

import pytest
from pyspark.sql import functions as F

from tickflow.functions.arith import round_double
from tickflow.operators import cuts
from tickflow.plans import fixtures as X
from tickflow.plans import streams as S
from tickflow.streaming import queries as P
from tickflow.streaming.sinks import write_batch_partition
from tickflow.streaming.sources import message_stream


def _sizes(df, name="share"):
    return {r[0]: r[1] for r in df.groupBy(name).count().collect()}


@pytest.mark.parametrize("key", [
    "id", "-id * 1000000007", "id % 3", "cast(null as bigint)", "if(id % 2 = 0, null, id)", "7L",
    "if(id = 5, -9223372036854775808L, if(id = 6, 9223372036854775807L, id))"])
def test_shares_are_equal_and_in_order(spark, key):
    df = spark.range(0, 1003, 1, 5).select(F.expr(f"cast({key} as bigint)").alias("a"), (-F.col("id")).alias("b"))
    got = cuts.in_shares(df, ["a", "b"], 1003, 4, "share").cache()
    assert got.columns == ["a", "b", "share"] and _sizes(got) == {0: 251, 1: 251, 2: 251, 3: 250}
    want = sorted(((r.a is not None, r.a or 0, r.b) for r in df.collect()))
    place = {k: i // 251 for i, k in enumerate(want)}
    assert all(place[(r.a is not None, r.a or 0, r.b)] == r.share for r in got.collect())


def test_shares_of_repeated_and_few_rows(spark):
    twice = spark.range(10).unionByName(spark.range(10)).select(F.col("id").alias("a"))
    assert _sizes(cuts.in_shares(twice, ["a"], 20, 4, "share")) == {k: 5 for k in range(4)}
    assert _sizes(cuts.in_shares(spark.range(2).toDF("a"), ["a"], 2, 4, "share")) == {0: 1, 1: 1}
    assert cuts.in_shares(spark.range(0).toDF("a"), ["a"], 0, 4, "share").count() == 0


def test_shares_stay_right_when_the_sketch_is_off(spark, monkeypatch):
    monkeypatch.setattr(cuts, "_bounds", lambda *_: [17, 600])
    got = cuts.in_shares(spark.range(1000).toDF("a"), ["a"], 1000, 4, "share")
    assert got.filter(F.floor(F.col("a") / 250) != F.col("share")).count() == 0 and got.count() == 1000


def test_only_rows_near_a_cut_are_numbered(spark, monkeypatch):
    seen = []

    def count(df, *args, **kw):
        seen.append(df.count())
        return ordinal(df, *args, **kw)
    ordinal = cuts.ordinal
    monkeypatch.setattr(cuts, "ordinal", count)
    got = cuts.in_shares(spark.range(200_000).toDF("a"), ["a"], 200_000, 4, "share")
    assert _sizes(got) == {k: 50_000 for k in range(4)}
    assert 0 < sum(seen) <= 2_000  # all 200,000 before


def test_a_replay_stages_without_sorting_messages(spark, tmp_root):
    spark.range(500).select(
        F.col("id").alias("event_id"), F.lit("a").alias("event_type"), F.col("id").cast("double").alias("value"),
        F.lit('{"k": 1}').alias("props"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"),
    ).write.parquet(f"{tmp_root}/events.parquet")
    feed, chunks = X.replay_feed(spark, tmp_root, "prices")
    assert feed.columns == ["chunk", "key", "value", "topic"] and chunks == 4
    plan = feed._jdf.queryExecution().optimizedPlan()
    assert "chunk" in plan.outputOrdering().toString()  # the write by chunk needs no sort of its own
    bad = {r[0] for r in feed.filter("value = cast('not json' as binary)").select(F.col("key").cast("string").cast("int")).collect()}
    assert feed.count() == 572 and bad == set(range(0, 500, 7))


def test_state_partitions_do_not_follow_the_shuffle_partitions(spark, tmp_root):
    X.price_messages(spark, "/root/testdata/sf0.001").limit(200).write.parquet(f"{tmp_root}/inbox")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        parts = S.state_partitions(spark)
        assert parts == 2 * spark.sparkContext.defaultParallelism
        q = P.start_window_log(message_stream(spark, "parquet", f"{tmp_root}/inbox"), f"{tmp_root}/out", f"{tmp_root}/ck",
                               {"availableNow": True}, state_partitions=parts)
        P.await_all(spark, [q])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    states = [d for d in os.listdir(f"{tmp_root}/ck/state/0".replace("file:", "")) if d.isdigit()]
    assert len(states) == parts
    assert spark.read.parquet(f"{tmp_root}/out").count() > 0


def test_a_batch_by_date_has_a_file_a_date(spark, tmp_root):
    df = spark.range(0, 3000, 1, 12).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("d"))
    write_batch_partition(df, 0, tmp_root, partition_by=("d",))
    files = [f for _, _, fs in os.walk(tmp_root.replace("file:", "")) for f in fs if f.endswith(".parquet")]
    assert len(files) == 9  # 108 before
    assert spark.read.parquet(tmp_root).count() == 3000


def test_rounding_without_text_equals_rounding_by_text(spark):
    odd = [None, float("nan"), float("inf"), -float("inf"), -0.0, 0.0, 5e-7, -5e-7, 4.999999e-7, 1e300, 1.0000005, 2.5e-6, 17592186.0444155]
    x = spark.createDataFrame([(v,) for v in odd], "x double").unionByName(
        spark.range(20_000).select(((F.col("id") + 0.5) / 1e6 * F.when(F.col("id") % 2 == 0, 1).otherwise(-3)).alias("x")))
    for scale in (0, 2, 6):
        off = x.filter(~round_double(F.col("x"), scale).eqNullSafe(F.round("x", scale) + F.lit(0.0)))
        assert off.count() == 0
    # the long way is left to values near the middle
    assert "CASE WHEN" in x.select(round_double(F.col("x")))._jdf.queryExecution().optimizedPlan().toString()


def test_buckets_of_stored_windows_follow_their_rows():
    assert S.window_buckets(0) == S.window_buckets(8_000_000) == 8
    assert S.window_buckets(50_000_001) == 51  # 8 before


def test_nested_import_casts_only_what_a_record_takes(spark):
    from tickflow.operators.metrics import import_nested
    doc = '{"m":{"data_points":[{"batch_size":2,"processing_time":{},"error_count":"x"},7,{"total_records":"3"}]}}'
    df = spark.createDataFrame([(doc,)], "document string")
    got = import_nested(df)
    assert [r.rows for r in got.orderBy("pos").collect()] == [2.0, None, 3.0]
    casts = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("try_variant_get") if x.startswith("(value")]
    assert not any("$.data_points" in x and "error_count" in x for x in casts)  # cast before
