"""Waiting for queries, restarts, the progress log, state and late rows."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from tickflow.plans import fixtures as X
from tickflow.plans import streams as S
from tickflow.session import move_files, table_version
from tickflow.streaming import queries as P
from tickflow.streaming.progress import ProgressLog, read_progress
from tickflow.streaming.sinks import write_batch_partition
from tickflow.streaming.sources import message_stream

SF = "/root/testdata/sf0.001"


def _inbox(spark, root, files=2):
    X.price_messages(spark, SF).limit(240).repartition(files).write.parquet(f"{root}/inbox")
    return f"{root}/inbox"


def _endless(spark, src, root, name):
    return (src.writeStream.format("noop").option("checkpointLocation", f"{root}/ck_{name}").queryName(name)
            .trigger(processingTime="1 hour").start())


def test_wait_returns_at_the_deadline(spark, tmp_root):
    src = message_stream(spark, "parquet", _inbox(spark, tmp_root))
    q = _endless(spark, src, tmp_root, "endless")
    try:
        t0 = time.monotonic()
        assert P.await_all(spark, [q], timeout_s=2) is False
        assert time.monotonic() - t0 < 6 and q.isActive
    finally:
        q.stop()
    assert P.await_all(spark, [q], timeout_s=20) is True


def test_two_waiters_at_once(spark, tmp_root):
    src = message_stream(spark, "parquet", _inbox(spark, tmp_root))
    done = []

    def run(k):
        for r in range(3):
            q = P.start_raw_prices(src, f"{tmp_root}/out{k}", f"{tmp_root}/ck{k}-{r}", {"availableNow": True}, name=f"w{k}")
            done.append(P.await_all(spark, [q], timeout_s=90))
    threads = [threading.Thread(target=run, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(200)
    assert done == [True] * 6


class FailsOnce:
    """foreachBatch sink that fails after writing its second batch."""

    def __init__(self, path, times=1):
        self.path, self.left = path, times

    def __call__(self, df, batch_id):
        write_batch_partition(df, batch_id, self.path)
        if batch_id >= 1 and self.left:
            self.left -= 1
            raise ValueError("lost the connection")


def _failing(spark, src, root, sink, interval="100 milliseconds"):
    return lambda: (src.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/ck").queryName("failing")
                    .trigger(processingTime=interval).start())


def test_a_query_that_fails_once_goes_on_without_loss_or_repeat(spark, tmp_root):
    inbox = _inbox(spark, tmp_root, files=4)
    src = message_stream(spark, "parquet", inbox, max_files_per_trigger=1)
    sink = FailsOnce(f"{tmp_root}/out")
    (last,) = P.supervise([_failing(spark, src, tmp_root, sink)], restarts=2, timeout_s=30)
    assert sink.left == 0 and not last.isActive
    out = spark.read.parquet(f"{tmp_root}/out")
    want = spark.read.parquet(inbox)
    assert out.select("batch_id").distinct().count() == 4
    assert sorted(map(repr, out.select("key", "value").collect())) == sorted(map(repr, want.select("key", "value").collect()))


def test_restarts_have_a_limit_and_stop_the_others(spark, tmp_root):
    inbox = _inbox(spark, tmp_root, files=4)
    src = message_stream(spark, "parquet", inbox, max_files_per_trigger=1)
    other = []

    def start_other():
        other.append(_endless(spark, src, tmp_root, "other"))
        return other[-1]
    with pytest.raises(RuntimeError, match="failed 3 times"):
        P.supervise([_failing(spark, src, tmp_root, FailsOnce(f"{tmp_root}/out", times=99)), start_other], restarts=2)
    assert len(other) == 1 and not other[0].isActive


def test_progress_log_is_complete(spark, tmp_root):
    """More micro-batches than the engine retains."""
    inbox = _inbox(spark, tmp_root, files=6)
    src = message_stream(spark, "parquet", inbox, max_files_per_trigger=1)
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with ProgressLog(spark, f"{tmp_root}/progress") as log:
            q = P.start_raw_prices(src, f"{tmp_root}/raw", f"{tmp_root}/ck", {"availableNow": True})
            P.await_all(spark, [q])
            log.wait([q])
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert len(q.recentProgress) <= 2
    got = read_progress(spark, f"{tmp_root}/progress").orderBy("batch_id").collect()
    assert [r.batch_id for r in got if r.input_rows] == list(range(6))
    files = sorted(spark.read.parquet(inbox).groupBy(F.input_file_name()).count().toPandas()["count"])
    # no micro-batch above the cap of one file
    assert sorted(r.input_rows for r in got if r.input_rows) == files
    assert all(r.trigger_ms > 0 and r.state_rows == 0 for r in got)


def test_wait_for_a_query_that_has_not_ended(spark, tmp_root):
    with ProgressLog(spark, f"{tmp_root}/progress") as log:
        q = _endless(spark, message_stream(spark, "parquet", _inbox(spark, tmp_root)), tmp_root, "running")
        with pytest.raises(TimeoutError):
            log.wait([q], timeout_s=1)
        q.stop()
        log.wait([q])


def test_caps_hold_in_the_registered_streams(spark):
    paths = S.run_replay(spark, SF, "capped")
    log = read_progress(spark, paths["progress"]).filter("input_rows > 0")
    files = [r[0] for r in spark.read.parquet(paths["inbox"]).groupBy(F.input_file_name()).count().select("count").collect()]
    most = sum(sorted(files)[-S.CAP_FILES:])
    raw = log.filter("query = 'raw_prices_capped'").collect()
    assert len(raw) == S.CAP_PARTS and max(r.input_rows for r in raw) <= most
    sized = log.filter("query = 'price_windows_capped'").collect()
    assert len(sized) >= S.CAP_PARTS and max(r.input_rows for r in sized) < sum(files)


def test_late_rows_are_dropped_and_counted(spark):
    got = {r.arrival: r for r in S.stream_late_dropped(spark, SF).collect()}
    assert got[2].late_rows > 0 and got[0].late_rows == got[3].late_rows == 0
    every, kept = S.stream_late_windows(spark, SF), S.stream_late_kept(spark, SF)
    assert kept.count() < every.count()


def test_open_windows_are_those_not_closed(spark):
    open_now = S.stream_open_windows(spark, SF).count()
    closed = S.stream_price_windows_watermark(spark, SF).count()
    assert open_now > 0 and open_now + closed == S.stream_price_windows_latest(spark, SF).count()


def test_moved_files_and_table_versions(spark, tmp_root):
    spark.range(4).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(f"{tmp_root}/t")
    before = table_version(spark, f"{tmp_root}/t")
    assert before == table_version(spark, f"{tmp_root}/t") and table_version(spark, f"{tmp_root}/none") == "none"
    for part in (0, 1, 7):
        move_files(spark, f"{tmp_root}/t/part={part}", f"{tmp_root}/in")
    assert sorted(r.id for r in spark.read.schema("id long").parquet(f"{tmp_root}/in").collect()) == [0, 1, 2, 3]
    assert table_version(spark, f"{tmp_root}/t") != before


def test_a_changed_table_is_replayed_anew(spark, tmp_root):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.limit(40).write.parquet(f"{tmp_root}/events.parquet")
    assert S.stream_raw_prices_capped(spark, tmp_root).count() == 40
    events.limit(60).write.mode("overwrite").parquet(f"{tmp_root}/events.parquet")
    assert S.stream_raw_prices_capped(spark, tmp_root).count() == 60
