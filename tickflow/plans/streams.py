"""Queries over the streaming replays.

Independent replays per session and table folder, each run when a query
first needs it (``run_replay``): prices and market in order, prices out of
time order, prices through capped sources.  The registered queries read what
the streaming queries wrote, their progress log and their state.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.functions.arith import round_double
from tickflow.operators import reconcile as R
from tickflow.operators.metrics import load_metrics
from tickflow.operators import windows as W
from tickflow.plans import fixtures as X
from tickflow.schemas import MARKET_TABLE, RAW_PRICES_TABLE, WINDOWS_TABLE
from tickflow.session import scratch_path, table_version, temporary_scratch
from tickflow.streaming import queries as P
from tickflow.streaming.progress import ProgressLog, read_progress
from tickflow.streaming.replay import replay
from tickflow.streaming.sinks import read_sink, store_bucketed
from tickflow.streaming.sources import message_stream

# Fixed value: watermark delay of the bounded-state variant.
WATERMARK = "30 minutes"

_RUNS: dict = {}
_LOCKS: dict = {}
_GUARD = threading.Lock()


def _table_of(part: str) -> str:
    return "lineitem" if part == "market" else "events"


def run_replay(spark: SparkSession, sf_dir: str, part: str = "prices") -> dict[str, str]:
    """Replays one feed once per (application, state of its table, part);
    returns the paths of what its queries wrote.

    ``prices`` runs raw prices, the window update log, the watermarked window
    log and the live windows (update mode with a watermark) over the price
    messages; ``market`` runs the market stream; ``late`` runs windows without
    and with a watermark and the tracked coins over price chunks that arrive
    out of time order; ``capped`` reads all price messages at once through
    sources that admit a bounded part of them to each micro-batch.
    The replays are independent, so a query waits only for its own feed.
    """
    sf_dir = sf_dir.rstrip("/")
    if part not in REPLAYS:
        raise ValueError(f"unknown part {part!r}")
    version = table_version(spark, f"{sf_dir}/{_table_of(part)}.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, part, version)
    with _GUARD:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        if key not in _RUNS:
            root = scratch_path(spark, f"replay-{part}")
            _RUNS[key] = REPLAYS[part](spark, sf_dir, root)
        return _RUNS[key]


ONCE = {"availableNow": True}
# State partitions of a replay's window queries, per core of the session.
STATE_PER_CORE = 2


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a window query's state: the session's shuffle partitions, but
    no more than STATE_PER_CORE a core, so that their number does not follow the input."""
    most = STATE_PER_CORE * spark.sparkContext.defaultParallelism
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, most))


def _paths(root: str, *names: str) -> dict[str, str]:
    return {n: f"{root}/{n}" for n in (*names, "metrics", "progress", "inbox", "staged", "ckpt")}


def _staged(spark: SparkSession, sf_dir: str, feed: str, paths: dict[str, str]) -> int:
    """Writes all messages of a feed by chunk, in one scan; returns the number of chunks."""
    messages, chunks = X.replay_feed(spark, sf_dir, feed)
    messages.write.partitionBy("chunk").parquet(paths["staged"])
    return chunks


def _replay_logged(spark: SparkSession, paths: dict[str, str], order: list[int], start) -> None:
    """Moves staged chunks to the inbox in ``order``, one replay step each, with every
    query's progress logged."""
    with ProgressLog(spark, paths["progress"]) as log:
        replay(spark, [(lambda k: f"{paths['staged']}/chunk={order[k]}", paths["inbox"])], len(order), start, log.wait)


def _replay_prices(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    paths = _paths(root, "raw", "windows", "windows_wm", "windows_live")
    ck, metrics, parts = paths["ckpt"], paths["metrics"], state_partitions(spark)

    def start():
        src = message_stream(spark, "parquet", paths["inbox"])
        return [P.start_raw_prices(src, paths["raw"], f"{ck}/raw", ONCE, metrics),
                P.start_window_log(src, paths["windows"], f"{ck}/windows", ONCE, metrics, state_partitions=parts),
                P.start_window_log(src, paths["windows_wm"], f"{ck}/windows_wm", ONCE, metrics,
                                   watermark=WATERMARK, name="price_windows_watermark", state_partitions=parts),
                P.start_window_log(src, paths["windows_live"], f"{ck}/windows_live", ONCE, metrics,
                                   watermark=WATERMARK, name="price_windows_live", output_mode="update",
                                   state_partitions=parts)]
    _replay_logged(spark, paths, list(range(_staged(spark, sf_dir, "prices", paths))), start)
    return paths


def _replay_market(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    paths = _paths(root, "market")

    def start():
        src = message_stream(spark, "parquet", paths["inbox"])
        return [P.start_market_metrics(src, paths["market"], f"{paths['ckpt']}/market", ONCE, paths["metrics"])]
    _replay_logged(spark, paths, list(range(_staged(spark, sf_dir, "market", paths))), start)
    return paths


def _replay_late(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    paths = _paths(root, "windows_late", "windows_late_wm", "tracked", "coins")
    ck, metrics, parts = paths["ckpt"], paths["metrics"], state_partitions(spark)
    order = X.late_order(_staged(spark, sf_dir, "prices", paths))
    done = iter(range(len(order)))

    def start():
        # the tracked coins change before the second half of the micro-batches
        half = next(done) >= len(order) // 2
        X.tracked_coin_table(spark, sf_dir, half).write.mode("overwrite").parquet(paths["coins"])
        src = message_stream(spark, "parquet", paths["inbox"])
        return [P.start_window_log(src, paths["windows_late"], f"{ck}/windows_late", ONCE, metrics, name="late_windows",
                                   state_partitions=parts),
                P.start_window_log(src, paths["windows_late_wm"], f"{ck}/windows_late_wm", ONCE, metrics,
                                   watermark=WATERMARK, name="late_windows_watermark", output_mode="update",
                                   state_partitions=parts),
                P.start_tracked_prices(src, lambda: spark.read.parquet(paths["coins"]), paths["tracked"],
                                       f"{ck}/tracked", ONCE, metrics)]
    _replay_logged(spark, paths, order, start)
    return paths


# Caps of the admission-controlled streams: files, and bytes, of a micro-batch.
CAP_FILES, CAP_PARTS = 3, 4


def _replay_capped(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    paths = _paths(root, "raw", "windows")
    X.price_messages(spark, sf_dir).repartition(CAP_FILES * CAP_PARTS).write.parquet(paths["inbox"])
    most = max(1, int(table_version(spark, paths["inbox"]).split("-")[1]) // CAP_PARTS)
    ck = paths["ckpt"]
    with ProgressLog(spark, paths["progress"]) as log:
        files = message_stream(spark, "parquet", paths["inbox"], max_files_per_trigger=CAP_FILES)
        sized = message_stream(spark, "parquet", paths["inbox"], maxBytesPerTrigger=most)
        qs = [P.start_raw_prices(files, paths["raw"], f"{ck}/raw", ONCE, paths["metrics"], name="raw_prices_capped"),
              P.start_window_log(sized, paths["windows"], f"{ck}/windows", ONCE, paths["metrics"],
                                 name="price_windows_capped", state_partitions=state_partitions(spark))]
        P.await_all(spark, qs)
        log.wait(qs)
    return paths


REPLAYS = {"prices": _replay_prices, "market": _replay_market, "late": _replay_late, "capped": _replay_capped}


def run_replays(spark: SparkSession, sf_dir: str, parts=("prices", "market")) -> dict[str, dict[str, str]]:
    """Runs several replays at once (one driver thread each; Spark schedules
    their jobs side by side) and returns their paths by part."""
    out, errors = {}, []

    def one(part):
        try:
            out[part] = run_replay(spark, sf_dir, part)
        except Exception as e:  # re-raised below, in the caller's thread
            errors.append(e)
    threads = [threading.Thread(target=one, args=(p,)) for p in parts]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return out


def _doubles(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


SINK_TABLES = {"raw": RAW_PRICES_TABLE, "market": MARKET_TABLE}


def _log(spark: SparkSession, paths: dict[str, str], which: str) -> DataFrame:
    return read_sink(spark, paths[which], SINK_TABLES.get(which, WINDOWS_TABLE))


def stream_raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid price rows the raw stream stored."""
    raw = _log(spark, run_replay(spark, sf_dir), "raw").filter(~F.col("is_reject"))
    return _doubles(raw.select(F.col("key").cast("string").cast("long").alias("event_id"), "coin_id",
                               "price_usd", "market_cap", "volume_24h", "timestamp"),
                    ["price_usd", "market_cap", "volume_24h"])


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 in the stream: messages the raw stream stored as rejects."""
    raw = _log(spark, run_replay(spark, sf_dir), "raw").filter(F.col("is_reject"))
    return raw.select(F.col("key").cast("string").cast("long").alias("event_id"),
                      F.col("_corrupt_record").alias("raw"), "batch_id")


def stream_market_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market rows the market stream stored."""
    m = _log(spark, run_replay(spark, sf_dir, "market"), "market").filter(~F.col("is_reject"))
    cols = ["price_change_24h", "market_cap_change_24h", "volume_change_24h"]
    return _doubles(m.select(F.col("key").cast("string").alias("message_key"), "coin_id", *cols, "timestamp"), cols)


def _windows_log(spark: SparkSession, sf_dir: str, which: str = "windows") -> DataFrame:
    return _log(spark, run_replay(spark, sf_dir), which).drop("is_reject")


def stream_price_windows_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update log, one row per window per batch that touched it."""
    return _doubles(_windows_log(spark, sf_dir), W.WINDOW_VALUES)


def stream_price_windows_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + D4: latest value of every window from the update log."""
    latest = P.latest_windows(_windows_log(spark, sf_dir))
    return _doubles(latest, W.WINDOW_VALUES)


def stream_price_windows_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows emitted once each by the watermarked append-mode query."""
    return _doubles(_windows_log(spark, sf_dir, "windows_wm").drop("batch_id"), W.WINDOW_VALUES)


def _compare(stream: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    c = R.compare_windows(stream, W.windowed(X.prices(spark, sf_dir)))
    return c.withColumns({d: round_double(F.col(d)) for d in R.DIFF_COLUMNS})


def compare_stream_batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored update log joined with the batch recomputation."""
    return _compare(_windows_log(spark, sf_dir), spark, sf_dir)


def compare_stream_batch_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 P5 on the latest view: every difference is 0."""
    return _compare(P.latest_windows(_windows_log(spark, sf_dir)), spark, sf_dir)


# Buckets of the stored windows that are compared, at least, and most rows of one.
BUCKETS, BUCKET_ROWS = 8, 1_000_000


def window_buckets(rows: int) -> int:
    """Buckets for stored windows of at most ``rows`` rows."""
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def bucketed_windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Latest stream windows and recomputed batch windows, stored in buckets of
    the window and coin."""
    log = _windows_log(spark, sf_dir)
    buckets = window_buckets(log.count())  # from the footers of the stored files
    sides = {"stream": P.latest_windows(log), "batch": W.windowed(X.prices(spark, sf_dir))}
    out = []
    for side, df in sides.items():
        path = temporary_scratch(spark, f"bucketed-{side}")
        table = f"windows_{side}_{path.rsplit('-', 1)[1]}"
        out.append(store_bucketed(df, table, path, W.WINDOW_KEYS, buckets))
    return out[0], out[1]


def compare_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 over stored windows on both sides, in equal buckets: no shuffle."""
    c = R.compare_windows(*bucketed_windows(spark, sf_dir))
    return c.withColumns({d: round_double(F.col(d).cast("double")) for d in R.DIFF_COLUMNS})


def consistency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global consistency of the update log against raw prices."""
    return R.consistency(_windows_log(spark, sf_dir), X.prices(spark, sf_dir))


def stored_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price rows the raw stream stored, in their stored types."""
    return _log(spark, run_replay(spark, sf_dir), "raw").filter(~F.col("is_reject"))


def _compare_stored(stream: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    c = R.compare_windows(stream, W.windowed(stored_prices(spark, sf_dir)))
    return c.withColumns({d: round_double(F.col(d).cast("double")) for d in R.DIFF_COLUMNS})


def compare_stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update log against windows over the stored prices."""
    return _compare_stored(_windows_log(spark, sf_dir), spark, sf_dir)


def compare_stored_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 J1 D12 on the latest view."""
    return _compare_stored(P.latest_windows(_windows_log(spark, sf_dir)), spark, sf_dir)


def consistency_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 over what was stored on both sides."""
    return R.consistency(_windows_log(spark, sf_dir), stored_prices(spark, sf_dir))


def stream_price_windows_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest value of every window from the live windows, whose state
    is bounded by a watermark."""
    return _doubles(P.latest_windows(_windows_log(spark, sf_dir, "windows_live")), W.WINDOW_VALUES)


def metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics log of both replays, read back."""
    paths = run_replays(spark, sf_dir)
    prices, market = (load_metrics(spark, paths[part]["metrics"]) for part in ("prices", "market"))
    return prices.unionByName(market)


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three batch analyses, run and timed once each over the stored
    tables; one metrics record per analysis (rows = input rows)."""
    from tickflow.plans.batch_run import run_batch
    m = run_batch(spark, X.prices(spark, sf_dir), X.market_rows(spark, sf_dir), _windows_log(spark, sf_dir))
    path = scratch_path(spark, "batch-metrics")
    m.write.parquet(path)
    return load_metrics(spark, path)


def _settled(metrics: DataFrame) -> DataFrame:
    """The columns of metrics records that do not depend on the clock."""
    return metrics.select("mode", "query", "seq", F.col("rows").cast("long").alias("rows"), "error_count",
                          (F.col("processing_time") >= 0).alias("timed"))


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metrics record per micro-batch that has input, of every
    streaming query: rows and rejected rows as observed during its write."""
    log = metrics_log(spark, sf_dir)
    return _settled(log.filter(~F.col("query").isin("price_windows_watermark", "price_windows_live")))


def stream_metrics_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and rows of the two watermarked queries, whose
    micro-batches without input depend on the engine: all batches together."""
    log = metrics_log(spark, sf_dir)
    return (log.filter(F.col("query").isin("price_windows_watermark", "price_windows_live"))
            .groupBy("mode", "query").agg(F.sum("rows").cast("long").alias("rows"),
                                          F.sum("error_count").alias("error_count")))


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 batch mode: one record per timed analysis, input rows as observed
    during its single write."""
    return _settled(batch_log(spark, sf_dir))


def _application(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from tickflow.plans.batch_run import run_application
    return run_application(spark, X.prices(spark, sf_dir), X.market_rows(spark, sf_dir), _windows_log(spark, sf_dir),
                           temporary_scratch(spark, "batch-run"), metrics_log(spark, sf_dir))


def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch application's last step: errors per mode over the
    metrics of its analyses and of the streams (times depend on the clock)."""
    r = _application(spark, sf_dir)["report"]
    return r.select("mode", "total_errors", (F.col("avg_latency") > 0).alias("timed"))


def batch_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistency that the batch application writes as its last step."""
    return _application(spark, sf_dir)["consistency"]


def batch_metrics_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: an analysis that fails (its table lacks a column) is recorded as an
    error; the others run."""
    import warnings

    from tickflow.plans.batch_run import run_batch
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        m = run_batch(spark, X.prices(spark, sf_dir), X.market_rows(spark, sf_dir).drop("volume_change_24h"),
                      _windows_log(spark, sf_dir))
    return _settled(m)


def stream_price_windows_latest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 with compaction: the log compacted through batch 1, then the latest
    view from the compacted table plus the later batches only."""
    log = _windows_log(spark, sf_dir)
    path = scratch_path(spark, "latest-compacted")
    P.compact_latest(log.filter(F.col("batch_id") <= 1), path)
    latest = P.latest_windows(log, spark.read.parquet(path))
    return _doubles(latest, W.WINDOW_VALUES)


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete progress log of the price replay's queries that have
    no watermark: input rows and rows in state of every micro-batch."""
    log = read_progress(spark, run_replay(spark, sf_dir)["progress"])
    return (log.filter(F.col("query").isin("raw_prices", "price_windows") & (F.col("input_rows") > 0))
            .select("query", "batch_id", "input_rows", "state_rows", "late_rows", (F.col("trigger_ms") >= 0).alias("timed")))


def stream_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest windows of a feed out of time order, without a watermark:
    every late row is in."""
    log = _log(spark, run_replay(spark, sf_dir, "late"), "windows_late").drop("is_reject")
    return _doubles(P.latest_windows(log), W.WINDOW_VALUES)


def stream_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per arriving chunk of that feed, its rows and the late windows
    of them that the watermark dropped, from the state operator's own count."""
    log = read_progress(spark, run_replay(spark, sf_dir, "late")["progress"])
    log = log.filter((F.col("query") == "late_windows_watermark") & (F.col("input_rows") > 0))
    # micro-batches without input depend on the engine: those with input are numbered anew
    arrival = F.row_number().over(Window.orderBy("batch_id")) - 1
    return log.select(arrival.cast("long").alias("arrival"), "input_rows", "late_rows")


def stream_late_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest windows of that feed with a watermark: without the rows
    that came after their window had closed."""
    log = _log(spark, run_replay(spark, sf_dir, "late"), "windows_late_wm").drop("is_reject")
    return _doubles(P.latest_windows(log), W.WINDOW_VALUES)


def stream_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 in the stream: rows of the coins tracked when their micro-batch ran."""
    schema = RAW_PRICES_TABLE
    rows = read_sink(spark, run_replay(spark, sf_dir, "late")["tracked"], schema)
    return _doubles(rows.select(F.col("key").cast("string").cast("long").alias("event_id"), "coin_id", "price_usd",
                                "timestamp", "batch_id"), ["price_usd"])


def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows still in the live query's state after its last restart,
    read from the checkpoint."""
    w = P.open_windows(spark, f"{run_replay(spark, sf_dir)['ckpt']}/windows_live")
    return w.withColumns({c: round_double(F.col(c)) for c in ("avg_price", "total_volume")})


def stream_raw_prices_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the raw stream stores when a micro-batch may read
    CAP_FILES files only."""
    raw = _log(spark, run_replay(spark, sf_dir, "capped"), "raw").filter(~F.col("is_reject"))
    return _doubles(raw.select(F.col("key").cast("string").cast("long").alias("event_id"), "coin_id",
                               "price_usd", "market_cap", "volume_24h", "timestamp"),
                    ["price_usd", "market_cap", "volume_24h"])


def stream_price_windows_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest windows when a micro-batch may read a CAP_PARTS-th of the bytes."""
    log = _log(spark, run_replay(spark, sf_dir, "capped"), "windows").drop("is_reject")
    return _doubles(P.latest_windows(log), W.WINDOW_VALUES)
