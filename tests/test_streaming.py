import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickflow.operators import windows as W
from tickflow.plans import fixtures as X
from tickflow.plans import streams as S
from tickflow.streaming import queries as P
from tickflow.streaming.replay import replay
from tickflow.streaming.sinks import write_batch_partition
from tickflow.streaming.sources import kafka_options, message_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def replayed(spark):
    return S.run_replay(spark, SF)


def test_latest_equals_batch(spark, replayed):
    latest = S.stream_price_windows_latest(spark, SF)
    batch = W.windowed(X.prices(spark, SF)).select(
        *W.WINDOW_KEYS, *[F.col(c).cast("decimal(20,8)").cast("double").alias(c) for c in
                          ("avg_price", "min_price", "max_price")],
        F.col("total_volume").cast("decimal(20,2)").cast("double").alias("total_volume"))
    assert latest.count() == batch.count()
    assert latest.exceptAll(batch).count() == 0 and batch.exceptAll(latest).count() == 0


def test_replay_batches_and_no_duplicates(spark, replayed):
    raw = spark.read.parquet(replayed["raw"])
    assert sorted(r.batch_id for r in raw.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
    n_events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert raw.filter(~F.col("is_reject")).count() == n_events
    assert raw.select("key", "is_reject").distinct().count() == raw.count()


def test_log_has_batch_ids_and_latest_collapses(spark, replayed):
    log = S.stream_price_windows_log(spark, SF)
    latest = S.stream_price_windows_latest(spark, SF)
    assert log.count() >= latest.count()
    assert log.select(*W.WINDOW_KEYS).distinct().count() == latest.count()


def test_latest_compare_is_all_zero(spark, replayed):
    c = S.compare_stream_batch_latest(spark, SF)
    nz = c.filter((F.col("avg_price_diff") != 0) | (F.col("min_price_diff") != 0) |
                  (F.col("max_price_diff") != 0) | (F.col("volume_diff") != 0))
    assert c.count() > 0 and nz.count() == 0


def test_metrics_one_row_per_batch(spark, replayed):
    m = S.stream_metrics(spark, SF)
    per_query = {r.query: r.n for r in m.groupBy("query").agg(F.count("*").alias("n")).collect()}
    assert per_query["raw_prices"] == 4 and per_query["price_windows"] == 4 and per_query["market_metrics"] == 4
    rej = m.filter(F.col("query") == "raw_prices").agg(F.sum("error_count")).first()[0]
    assert rej == S.stream_rejects(spark, SF).count()


def test_batch_replay_is_idempotent(spark, tmp_root):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    write_batch_partition(df, 3, tmp_root)
    write_batch_partition(df, 3, tmp_root)
    write_batch_partition(df.limit(2), 4, tmp_root)
    out = spark.read.parquet(tmp_root)
    assert out.count() == 7 and out.filter("batch_id = 3").count() == 5


def _price_msg(coin, price, t):
    ms = int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return json.dumps({"coin_id": coin, "price_usd": price, "market_cap": 1.0, "volume_24h": 1.0, "timestamp": ms})


def _late_run(spark, root, watermark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    chunks = [[("a", 1.0, t0)], [("a", 2.0, t0 + dt.timedelta(hours=2))], [("a", 5.0, t0 + dt.timedelta(minutes=1))]]
    rows = [(str(i).encode(), _price_msg(*m).encode(), "p", k) for k, ch in enumerate(chunks) for i, m in enumerate(ch)]
    feed = spark.createDataFrame(rows, "key binary, value binary, topic string, chunk int")
    inbox, out = f"{root}/inbox", f"{root}/out"

    def chunk(k):
        return feed.filter(F.col("chunk") == k).drop("chunk")

    def start():
        src = message_stream(spark, "parquet", inbox)
        return [P.start_window_log(src, out, f"{root}/ck", {"availableNow": True}, watermark=watermark)]

    replay(spark, [(chunk, inbox)], 3, start)
    return spark.read.parquet(out)


def test_late_rows_update_old_window_without_watermark(spark, tmp_root):
    log = _late_run(spark, tmp_root, None)
    w = log.filter((F.col("window_start") == dt.datetime(2024, 1, 1, 10, 0)) & (F.col("batch_id") == 2)).first()
    assert w is not None and float(w.avg_price) == 3.0


def test_watermark_drops_late_rows_and_emits_once(spark, tmp_root):
    log = _late_run(spark, tmp_root, "30 minutes")
    assert log.groupBy(*W.WINDOW_KEYS).count().filter("count > 1").count() == 0
    early = log.filter(F.col("window_start") <= dt.datetime(2024, 1, 1, 10, 0)).collect()
    assert early and all(float(r.avg_price) == 1.0 for r in early)   # the late 5.0 was dropped


def test_kafka_options():
    o = kafka_options("broker:9092", "prices", max_offsets_per_trigger=1000)
    assert o["subscribe"] == "prices" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "false" and o["maxOffsetsPerTrigger"] == "1000"


def test_batch_metrics_one_record_per_analysis(spark, replayed):
    m = S.batch_metrics(spark, SF).collect()
    by = {r.query: r for r in m}
    assert set(by) == {"price_analysis", "market_analysis", "comparison"}
    n_events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert by["price_analysis"].rows == n_events and all(r.mode == "batch" for r in m)


def test_run_all_fails_fast(spark, tmp_root):
    from tickflow.streaming.app import start_all
    from tickflow.streaming.progress import progress_records
    inbox = f"{tmp_root}/inbox"
    X.price_messages(spark, SF).limit(250).write.parquet(inbox)
    src = message_stream(spark, "parquet", inbox)
    once = {"availableNow": True}
    qs = start_all(src, src, f"{tmp_root}/out", f"{tmp_root}/ck", once, once)
    P.await_all(spark, qs)
    prog = progress_records(spark, qs)
    assert prog.count() >= 3 and prog.filter("rows > 0").count() >= 3

    def boom(df, batch_id):
        raise ValueError("sink down")
    bad = src.writeStream.foreachBatch(boom).option("checkpointLocation", f"{tmp_root}/ck_bad") \
             .trigger(availableNow=True).start()
    slow = src.writeStream.format("noop").option("checkpointLocation", f"{tmp_root}/ck_slow") \
              .trigger(processingTime="1 hour").start()
    with pytest.raises(RuntimeError):
        P.await_all(spark, [bad, slow])
    assert not slow.isActive


def test_rate_cap_one_file_per_batch(spark, tmp_root):
    inbox = f"{tmp_root}/inbox"
    for k in range(3):
        X.price_messages(spark, SF).limit(250).coalesce(1).write.mode("append").parquet(inbox)
    src = message_stream(spark, "parquet", inbox, max_files_per_trigger=1)
    q = P.start_raw_prices(src, f"{tmp_root}/raw", f"{tmp_root}/ck", {"availableNow": True})
    q.awaitTermination()
    raw = spark.read.parquet(f"{tmp_root}/raw")
    assert raw.select("batch_id").distinct().count() == 3


def test_raw_sink_prunes_by_date(spark, replayed):
    import datetime as dt
    raw = spark.read.parquet(replayed["raw"])
    day = raw.filter(F.col("event_date") == dt.date(2024, 1, 1))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert day.count() == raw.filter(F.to_date("timestamp") == dt.date(2024, 1, 1)).count() > 0


def test_metered_sink_retry_of_a_batch_changes_nothing(spark, tmp_root):
    from tickflow.streaming.sinks import MeteredSink
    out, met = f"{tmp_root}/out", f"{tmp_root}/metrics"
    sink = MeteredSink("q", lambda df: df.withColumn("is_reject", F.col("id") % 3 == 0),
                       lambda df, b: write_batch_partition(df, b, out), met, reject_col="is_reject")
    batch = spark.range(9)
    sink(batch, 0)
    sink(batch, 1)
    sink(batch, 1)          # the retry of batch 1 after a failure
    assert spark.read.parquet(out).count() == 18
    m = spark.read.parquet(met).collect()
    assert len(m) == 2 and all(r.rows == 9.0 and r.error_count == 3 for r in m)


def test_run_all_completes_with_available_now(spark, tmp_root):
    from tickflow.streaming.app import run_all
    inbox = f"{tmp_root}/inbox"
    X.price_messages(spark, SF).limit(250).write.parquet(inbox)
    src = message_stream(spark, "parquet", inbox)
    once = {"availableNow": True}
    qs = run_all(spark, src, src, f"{tmp_root}/out", f"{tmp_root}/ck", once, once)
    assert len(qs) == 3 and not any(q.isActive for q in qs)
    assert spark.read.parquet(f"{tmp_root}/out/windows").count() > 0


def test_compacted_latest_equals_full_latest(spark, replayed, tmp_root):
    log = spark.read.parquet(replayed["windows"]).drop("is_reject")
    early = log.filter(F.col("batch_id") <= 1)
    P.compact_latest(early, f"{tmp_root}/c1")
    compacted = spark.read.parquet(f"{tmp_root}/c1")
    assert compacted.agg(F.max("batch_id")).first()[0] == 1
    full = P.latest_windows(log)
    incr = P.latest_windows(log, compacted)
    assert incr.count() == full.count()
    assert incr.exceptAll(full).count() == 0 and full.exceptAll(incr).count() == 0
    # the later batches are read with a partition filter on batch_id
    plan = log.filter(F.col("batch_id") > F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_kafka_without_connector_says_what_is_missing(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        message_stream(spark, "kafka", **kafka_options("localhost:1", "prices"))


def test_partly_bad_message_counts_in_windows(spark, tmp_root):
    from tickflow.schemas import ENVELOPE, WINDOWS_TABLE
    from tickflow.streaming import queries as P
    from tickflow.streaming.sinks import read_sink
    from tickflow.streaming.sources import message_stream
    rows = [(b"1", b'{"coin_id":"a","price_usd":"x","market_cap":1,"volume_24h":10,"timestamp":1700000000000}', "t"),
            (b"2", b'{"coin_id":"a","price_usd":2,"market_cap":1,"volume_24h":5,"timestamp":1700000000000}', "t"),
            (b"3", b"not json", "t"), (b"4", None, "t")]
    spark.createDataFrame(rows, ENVELOPE).write.parquet(f"{tmp_root}/in")
    q = P.start_window_log(message_stream(spark, "parquet", f"{tmp_root}/in"), f"{tmp_root}/w", f"{tmp_root}/c",
                           {"availableNow": True})
    P.await_all(spark, [q])
    got = read_sink(spark, f"{tmp_root}/w", WINDOWS_TABLE).collect()
    assert len(got) == 3 and all(r.total_volume == 15 and r.avg_price == 2 for r in got)


def test_trigger_defaults():
    from tickflow.streaming import queries as P
    assert P.PRICE_TRIGGER == {"processingTime": "90 seconds"}
    assert P.MARKET_TRIGGER == {"processingTime": "60 seconds"}


def test_replay_feed_reaches_every_row(spark, tmp_root):
    from tickflow.plans import fixtures as X
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(200)
    odd = e.limit(4).withColumn("event_id", F.expr(
        "element_at(array(NULL, -5L, 1000000000000000L, NULL), cast(event_id % 4 + 1 as int))"))
    e.unionByName(odd).write.parquet(f"{tmp_root}/events.parquet")
    feed, chunks = X.replay_feed(spark, tmp_root, "prices")
    per = {r["chunk"]: r["n"] for r in feed.filter("value <> cast('not json' as binary)").groupBy("chunk")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert chunks == 4 and sum(per.values()) == 204 and max(per.values()) == 51


def test_stream_queries_on_an_empty_table(spark, tmp_root):
    from tickflow.plans import streams
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).write.parquet(f"{tmp_root}/events.parquet")
    for q in (streams.stream_raw_prices, streams.stream_rejects, streams.stream_price_windows_log,
              streams.stream_price_windows_latest, streams.stream_price_windows_watermark,
              streams.stream_price_windows_live, streams.compare_stored_log):
        assert q(spark, tmp_root).count() == 0
