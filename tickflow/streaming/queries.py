"""The streaming queries: raw prices (K1), window update log (K2), market
metrics (K3), each a ``foreachBatch`` query with its own checkpoint."""

from __future__ import annotations

import threading
import time
import warnings
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickflow.functions import messages as M
from tickflow.functions.timecols import as_instant, as_wallclock, ingest_ms
from tickflow.operators.market import tracked
from tickflow.operators.typed_sink import to_sink_types
from tickflow.operators.windows import WINDOW_KEYS, WINDOW_VALUES, flatten_window, window_aggregates
from tickflow.schemas import (MARKET_MESSAGE, MARKET_SINK_DECIMALS, PRICE_MESSAGE,
                              PRICE_SINK_DECIMALS, WINDOW_SINK_DECIMALS)
from tickflow.streaming.sinks import MeteredSink, write_batch_partition

# Trigger intervals of the reference deployment.
PRICE_TRIGGER = {"processingTime": "90 seconds"}
MARKET_TRIGGER = {"processingTime": "60 seconds"}


def warn_of_heap_state(spark: SparkSession) -> None:
    """Window state kept on the JVM heap does not suit many open windows."""
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    if "RocksDB" not in provider:
        warnings.warn("window state is kept on the heap: set spark.sql.streaming.stateStore.providerClass "
                      "to the RocksDB provider", stacklevel=3)


_SETTING = threading.Lock()


@contextmanager
def _shuffle_partitions(spark: SparkSession, n: int | None):
    """Queries started inside have ``n`` shuffle partitions (None: the session's):
    a query copies the session's settings as it starts."""
    if n is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    with _SETTING:
        before = spark.conf.get(key)
        spark.conf.set(key, str(n))
        try:
            yield
        finally:
            spark.conf.set(key, before)


def _start(df: DataFrame, sink, checkpoint: str, name: str, trigger: dict, mode: str) -> StreamingQuery:
    return (df.writeStream.foreachBatch(sink).outputMode(mode)
              .option("checkpointLocation", checkpoint).queryName(name)
              .trigger(**trigger).start())


def _typed_rows(messages: DataFrame, schema, decimals: dict) -> DataFrame:
    """Decoded rows with arrival time, sink types and one ``is_reject`` flag
    (undecodable message or a value that overflows its column)."""
    d = M.flag_rejects(M.decode(messages, schema, with_corrupt=True))
    d = d.withColumns({"ingest_ms": ingest_ms(), "event_date": F.to_date("timestamp")})
    t = to_sink_types(d, decimals, flag="_overflow")
    return t.withColumn("is_reject", F.col("is_reject") | F.col("_overflow")).drop("_overflow")


def start_raw_prices(messages: DataFrame, sink_path: str, checkpoint: str, trigger: dict | None = None,
                     metrics_path: str | None = None, name: str = "raw_prices",
                     date_partitions: bool = True) -> StreamingQuery:
    """K1: every decoded price message, valid and rejected alike, appended per
    micro-batch in one write; ``is_reject`` separates them.

    With ``date_partitions`` rows are stored under batch_id=/event_date= so a
    time-range read prunes by date, rows of a date together: about a file per
    date and micro-batch.  That suits a feed whose micro-batches span few
    dates; a batch spanning years of event dates would write many small
    files, so turn it off there."""
    rows = _typed_rows(messages, PRICE_MESSAGE, PRICE_SINK_DECIMALS)
    parts = ("event_date",) if date_partitions else ()
    sink = MeteredSink(name, lambda df: df,
                       lambda df, b: write_batch_partition(df, b, sink_path, partition_by=parts),
                       metrics_path, reject_col="is_reject")
    return _start(rows, sink, checkpoint, name, trigger or PRICE_TRIGGER, "append")


def start_market_metrics(messages: DataFrame, sink_path: str, checkpoint: str, trigger: dict | None = None,
                         metrics_path: str | None = None, name: str = "market_metrics",
                         date_partitions: bool = False) -> StreamingQuery:
    """K3: decoded market messages appended per micro-batch (``date_partitions``
    as for :func:`start_raw_prices`)."""
    rows = _typed_rows(messages, MARKET_MESSAGE, MARKET_SINK_DECIMALS)
    parts = ("event_date",) if date_partitions else ()
    sink = MeteredSink(name, lambda df: df,
                       lambda df, b: write_batch_partition(df, b, sink_path, partition_by=parts),
                       metrics_path, reject_col="is_reject")
    return _start(rows, sink, checkpoint, name, trigger or MARKET_TRIGGER, "append")


def window_stream(messages: DataFrame, watermark: str | None = None) -> DataFrame:
    """Price rows of a message stream aggregated by sliding window.

    A message with one wrong-typed field counts with its other fields; one
    that does not decode at all has no time and so falls in no window.

    Without ``watermark`` state is never evicted and late rows are always
    accepted; with it, event time becomes an instant and each window is
    final once the watermark passes its end."""
    rows = M.decode(messages, PRICE_MESSAGE)
    if watermark:
        rows = rows.withColumn("timestamp", as_instant("timestamp")).withWatermark("timestamp", watermark)
    return window_aggregates(rows)


def stored_windows(df: DataFrame) -> DataFrame:
    """Window rows in the stored form: flat, NTZ UTC bounds, sink decimals."""
    f = flatten_window(df)
    if dict(f.dtypes)["window_start"] == "timestamp":
        f = f.withColumns({"window_start": as_wallclock("window_start"), "window_end": as_wallclock("window_end")})
    return to_sink_types(f, WINDOW_SINK_DECIMALS, flag="is_reject")


def start_window_log(messages: DataFrame, sink_path: str, checkpoint: str, trigger: dict | None = None,
                     metrics_path: str | None = None, watermark: str | None = None,
                     name: str = "price_windows", output_mode: str | None = None,
                     state_partitions: int | None = None) -> StreamingQuery:
    """K2: sliding-window aggregate.  Update mode writes every window a
    micro-batch touched, with all its rows so far, under that batch's id: an
    update log.  Append mode needs a ``watermark`` and writes each window
    once, when it closes.  The default is append with a watermark and update
    without; update with a watermark gives live windows with bounded state.

    ``state_partitions`` is the number of partitions of the state at the first
    start (None: the session's shuffle partitions).  Every task of the state
    reports on all partitions, so what micro-batches send to the driver grows with
    the square of it: a few per core suffice, whatever the input."""
    output_mode = output_mode or ("append" if watermark else "update")
    warn_of_heap_state(messages.sparkSession)
    agg = window_stream(messages, watermark)
    sink = MeteredSink(name, stored_windows, lambda df, b: write_batch_partition(df, b, sink_path),
                       metrics_path, reject_col="is_reject")
    with _shuffle_partitions(messages.sparkSession, state_partitions):
        return _start(agg, sink, checkpoint, name, trigger or PRICE_TRIGGER, output_mode)


def _since(log: DataFrame, compacted: DataFrame | None) -> DataFrame:
    """The compacted table plus the log batches written after it (the
    batch_id filter prunes the log's partitions)."""
    if compacted is None:
        return log
    upto = compacted.agg(F.max("batch_id")).first()[0]
    newer = log.filter(F.col("batch_id") > F.lit(upto)) if upto is not None else log
    return compacted.unionByName(newer, allowMissingColumns=True)


def _latest_rows(log: DataFrame) -> DataFrame:
    # one scalar per column keeps both sides hash aggregates; a window has one row per batch_id
    last = [F.max_by(c, "batch_id").alias(c) for c in WINDOW_VALUES]
    return log.groupBy(*WINDOW_KEYS).agg(*last, F.max("batch_id").alias("batch_id"))


def latest_windows(log: DataFrame, compacted: DataFrame | None = None) -> DataFrame:
    """Current value of each window from an update log: the row of the
    highest batch_id per (window_start, window_end, coin_id).

    With ``compacted`` (a table written by :func:`compact_latest`) only the
    log batches after it are read, so the cost follows the new batches, not
    the whole log."""
    return _latest_rows(_since(log, compacted)).drop("batch_id")


def compact_latest(log: DataFrame, out_path: str, compacted: DataFrame | None = None) -> None:
    """Write the latest row of every window, with the batch_id it came from,
    to ``out_path`` (a new location; read it back as ``compacted``)."""
    _latest_rows(_since(log, compacted)).write.mode("overwrite").parquet(out_path)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows a query of :func:`start_window_log` still holds in its
    state, read from its checkpoint: flat bounds (UTC wall clock), coin and
    the values so far.  The query need not run."""
    s = spark.read.format("statestore").load(checkpoint)
    # key and buffers have names of the engine's: taken by position, in the order of the aggregates
    s = _by_position(s, "key", ["window", "coin_id"])
    s = _by_position(s, "value", ["price_sum", "price_count", *WINDOW_VALUES[1:]])
    bounds = {b: F.col(f"window.{b}") for b in ("start", "end")}
    if s.schema["window"].dataType["start"].dataType.typeName() == "timestamp":
        bounds = {b: as_wallclock(c) for b, c in bounds.items()}
    return s.select(bounds["start"].alias("window_start"), bounds["end"].alias("window_end"), "coin_id",
                    F.try_divide("price_sum", "price_count").alias("avg_price"), *WINDOW_VALUES[1:])


def _by_position(df: DataFrame, struct: str, names: list[str]) -> DataFrame:
    """The fields of a struct column as columns of these names."""
    fields = df.schema[struct].dataType.fields
    if len(fields) != len(names):
        raise ValueError(f"{struct} has {len(fields)} fields, not {names}")
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields)])
    return df.withColumn(struct, F.col(struct).cast(named)).select("*", f"{struct}.*").drop(struct)


def start_tracked_prices(messages: DataFrame, coins: Callable[[], DataFrame], sink_path: str, checkpoint: str,
                         trigger: dict | None = None, metrics_path: str | None = None,
                         name: str = "tracked_prices") -> StreamingQuery:
    """Price rows of the coins tracked at the time of their micro-batch.

    ``coins`` gives the tracked-coin table and is called for every
    micro-batch, so a table that changes between batches counts from the next
    one on; ``market.tracked`` decides whether it is small enough to broadcast."""
    rows = _typed_rows(messages, PRICE_MESSAGE, PRICE_SINK_DECIMALS)
    sink = MeteredSink(name, lambda df: tracked(df, coins()), lambda df, b: write_batch_partition(df, b, sink_path),
                       metrics_path, reject_col="is_reject")
    return _start(rows, sink, checkpoint, name, trigger or PRICE_TRIGGER, "append")


# Seconds between two looks at a query.
POLL_S = 0.2


def _ended(q: StreamingQuery, wait_s: float) -> bool:
    """Whether ``q`` ends within ``wait_s``; its failure is read from it, not raised."""
    try:
        return bool(q.awaitTermination(max(wait_s, 0.001)))
    except StreamingQueryException:
        return True


def await_all(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None) -> bool:
    """Wait until every query ends; the first failure stops the rest and is
    raised.  False when ``timeout_s`` seconds passed first (the queries run on).

    Each query is waited for by itself, so several callers may wait at once."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    pending = list(queries)
    while pending:
        for q in list(pending):
            left = POLL_S / len(pending) if deadline is None else min(POLL_S / len(pending), deadline - time.monotonic())
            if not _ended(q, left) and q.isActive:
                continue
            pending.remove(q)
            err = q.exception()
            if err is not None:
                for other in pending:
                    other.stop()
                raise RuntimeError(f"streaming query {q.name} failed: {err}")
        if pending and deadline is not None and time.monotonic() >= deadline:
            return False
    return True


def supervise(starts: list[Callable[[], StreamingQuery]], restarts: int = 3,
              timeout_s: float | None = None) -> list[StreamingQuery]:
    """Runs the queries that ``starts`` start and starts a failed one again,
    from its checkpoint, up to ``restarts`` times each; beyond that the others
    are stopped and its failure is raised.

    Returns when all have ended, or after ``timeout_s`` seconds, when those
    still running are stopped after the micro-batch they are in.  The
    returned list holds each query's last run."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    runs = [start() for start in starts]
    failed, live = [0] * len(runs), set(range(len(runs)))
    try:
        while live and (deadline is None or time.monotonic() < deadline):
            for k in sorted(live):
                if not _ended(runs[k], POLL_S / len(live)) and runs[k].isActive:
                    continue
                err = runs[k].exception()
                if err is None:
                    live.discard(k)
                    continue
                failed[k] += 1
                if failed[k] > restarts:
                    raise RuntimeError(f"streaming query {runs[k].name} failed {failed[k]} times: {err}")
                runs[k] = starts[k]()
    finally:
        for k in live:
            _stop_between_batches(runs[k])
    return runs


def _stop_between_batches(q: StreamingQuery, wait_s: float = 60) -> None:
    """Stops ``q`` once it is not inside a micro-batch, or after ``wait_s``."""
    until = time.monotonic() + wait_s
    while q.isActive and q.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.05)
    q.stop()
