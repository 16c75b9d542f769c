"""DuckDB SQL giving the same result as each registered query.

Views ``events`` and ``lineitem`` (and the other driver tables) are
registered by the caller.  Doubles are rounded like the Spark side and
``+ 0.0`` turns -0.0 into 0.0.
"""

from __future__ import annotations

PRICES = """p AS (
  SELECT event_id, event_type AS coin_id, value AS price_usd, value * 1000 AS market_cap,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume_24h, ts AS timestamp
  FROM events)"""

# every row falls in the three 15-minute windows starting at its 5-minute
# bucket and the two buckets before it
WIN = """x AS (
  SELECT p.*, time_bucket(INTERVAL 5 MINUTE, timestamp) - k * INTERVAL 5 MINUTE AS ws
  FROM p, range(3) r(k) WHERE timestamp IS NOT NULL)"""

BATCH_AGG = """bt AS (
  SELECT ws, coin_id, avg(price_usd) AS a, min(price_usd) AS mi, max(price_usd) AS ma,
         sum(volume_24h) AS v, count(*) AS n
  FROM x GROUP BY ws, coin_id)"""


# sums of doubles in units of 2^-72, rounded once: through text, since the
# engine's own cast of a 128-bit number to double rounds its halves apart
def exact_sum(x: str, over: str = "") -> str:
    return f"CAST(CAST(sum(CAST(({x}) * pow(2.0, 72) AS HUGEINT)) {over} AS VARCHAR) AS DOUBLE) / pow(2.0, 72)"


def exact_avg(x: str) -> str:
    return f"{exact_sum(x)} / count({x})"


BATCH_EXACT = f"""bt AS (
  SELECT ws, coin_id, {exact_avg('price_usd')} AS a, min(price_usd) AS mi, max(price_usd) AS ma,
         {exact_sum('volume_24h')} AS v
  FROM x GROUP BY ws, coin_id)"""


def price_window_agg() -> str:
    return f"""WITH {PRICES}, {WIN}, {BATCH_EXACT}
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, coin_id,
       a AS avg_price, mi AS min_price, ma AS max_price, v AS total_volume
FROM bt"""


TRACKED = "('click', 'purchase', 'view')"

METRICS = """m AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'streaming' ELSE 'batch' END AS mode,
         l_orderkey * 8 + l_linenumber AS seq, l_orderkey, l_linenumber,
         l_quantity AS rows,
         CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_extendedprice END AS processing_time,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS error_count,
         l_discount * 100 AS cpu_percent, l_tax * 100 AS memory_percent, l_quantity / 100 AS memory_used_gb
  FROM lineitem),
 mt AS (SELECT *, CASE WHEN processing_time > 0 THEN rows / processing_time ELSE 0.0 END AS throughput FROM m)"""


def _r(c, alias=None):
    return f"round({c}, 6) + 0.0 AS {alias or c}"


def decode_prices() -> str:
    return f"""WITH {PRICES}
SELECT event_id, coin_id, price_usd, {_r('market_cap')}, volume_24h,
       date_trunc('second', timestamp) AS timestamp
FROM p"""


def decode_rejects() -> str:
    return "SELECT event_id, 'not json' AS raw FROM events WHERE event_id % 7 = 0"


def decode_market() -> str:
    return """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS message_key,
       l_returnflag || l_linestatus AS coin_id, l_discount * 100 AS price_change_24h,
       l_tax * 100 AS market_cap_change_24h, l_extendedprice AS volume_change_24h,
       date_trunc('second', l_shipdate) AS timestamp
FROM lineitem"""


def market_avg_changes() -> str:
    return f"""SELECT l_returnflag || l_linestatus AS coin_id,
       {exact_avg('l_discount * 100')} AS avg_price_change,
       {exact_avg('l_tax * 100')} AS avg_market_cap_change,
       {exact_avg('l_extendedprice')} AS avg_volume_change
FROM lineitem GROUP BY 1"""


def tracked_coins() -> str:
    return f"""WITH {PRICES}
SELECT event_id, coin_id, price_usd, {_r('market_cap')}, volume_24h, timestamp
FROM p WHERE coin_id IN {TRACKED}"""


def top_market_cap() -> str:
    return f"""WITH {PRICES}
SELECT coin_id, {_r('max(market_cap)', 'market_cap')} FROM p GROUP BY coin_id
ORDER BY max(market_cap) DESC, coin_id LIMIT 3"""


def flatten_simple_price() -> str:
    return """SELECT event_id, event_type AS coin_id, value AS price_usd,
       CASE event_id % 5 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE value * 2 END AS market_cap,
       CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS volume_24h
FROM events WHERE event_id % 11 <> 0"""


def flatten_markets() -> str:
    return """SELECT l_orderkey, l_returnflag || l_linestatus AS coin_id, l_discount AS price_change_24h,
       l_tax AS market_cap_change_24h, l_extendedprice AS volume_change_24h
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linestatus || l_returnflag, l_tax, l_discount, l_extendedprice FROM lineitem"""


def flatten_simple_price_rejects() -> str:
    return """SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN event_type END AS coin_id,
       CASE WHEN event_id % 19 = 0 THEN 'oops' END AS raw
FROM events WHERE event_id % 19 = 0 OR event_id % 11 = 0"""


def flatten_markets_rejects() -> str:
    return "SELECT l_orderkey, l_linenumber, 'oops' AS raw FROM lineitem WHERE l_orderkey % 19 = 0"


def metrics_nested_rejects() -> str:
    return """SELECT l_orderkey * 8 + l_linenumber AS doc_id, 'oops' AS raw
FROM lineitem WHERE (l_orderkey * 8 + l_linenumber) % 19 = 0"""


def sink_typed_prices() -> str:
    return f"""WITH {PRICES}
SELECT event_id, coin_id, CAST(CAST(price_usd AS DECIMAL(30,8)) AS DOUBLE) AS price_usd,
       CAST(CAST(market_cap AS DECIMAL(30,2)) AS DOUBLE) AS market_cap,
       CAST(CAST(volume_24h AS DECIMAL(30,2)) AS DOUBLE) AS volume_24h, timestamp, false AS is_reject
FROM p"""


def metrics_report() -> str:
    return f"""WITH {METRICS}, modes AS (SELECT * FROM (VALUES ('streaming'), ('batch')) v(mode)),
 a AS (SELECT mode, avg(processing_time) AS lat, avg(throughput) AS thr, sum(error_count) AS err,
              avg(cpu_percent) AS cpu, avg(memory_percent) AS mem FROM mt GROUP BY mode)
SELECT modes.mode, {_r('coalesce(lat, 0.0)', 'avg_latency')}, {_r('coalesce(thr, 0.0)', 'avg_throughput')},
       CAST(coalesce(err, 0) AS BIGINT) AS total_errors,
       {_r('coalesce(cpu, 0.0)', 'avg_cpu_usage')}, {_r('coalesce(mem, 0.0)', 'avg_memory_usage')}
FROM modes LEFT JOIN a ON a.mode = modes.mode"""


def _series(mode: str) -> str:
    return f"""WITH {METRICS}, s AS (SELECT * REPLACE ({mode} AS mode) FROM mt)
SELECT mode, row_number() OVER (PARTITION BY mode
         ORDER BY seq, processing_time, throughput, cpu_percent, memory_percent) - 1 AS idx,
       {_r('processing_time', 'latency')}, {_r('throughput')}, {_r('cpu_percent')}, {_r('memory_percent')}
FROM s"""


def metrics_series() -> str:
    return _series("mode")


def metrics_series_null_mode() -> str:
    return _series("CASE WHEN seq % 5 <> 0 THEN mode END")


def metrics_nested_import() -> str:
    other = "CASE WHEN mode = 'streaming' THEN 'batch' ELSE 'streaming' END"

    def entry(mode, pos, times, where=""):
        return f"""SELECT seq AS doc_id, {mode} AS mode, CAST({pos} AS BIGINT) AS pos, rows * {times} AS rows,
       {_r('processing_time')},
       round(CASE WHEN processing_time > 0 THEN rows * {times} / processing_time ELSE 0.0 END, 6) + 0.0 AS throughput,
       error_count, {_r('cpu_percent')}, {_r('memory_percent')}, {_r('memory_used_gb')}
FROM m {where}"""

    return (f"WITH {METRICS} " + entry("mode", 0, 1) + " UNION ALL " + entry("mode", 1, 2)
            + " UNION ALL " + entry(other, 0, 1, "WHERE error_count = 1"))


# micro-batch of a replayed event: its place in the order of ids, div a quarter of the rows (rounded up)
PLACE = "(row_number() OVER (ORDER BY event_id NULLS FIRST) - 1) // (SELECT (count(*) + 3) // 4 FROM events)"


def _dec(c, p, s, alias):
    return f"CAST(CAST({c} AS DECIMAL({p},{s})) AS DOUBLE) AS {alias}"


STREAM_X = f"""x AS (
  SELECT p.*, time_bucket(INTERVAL 5 MINUTE, timestamp) - k * INTERVAL 5 MINUTE AS ws
  FROM (SELECT p.*, {PLACE} AS b FROM p) p, range(3) r(k) WHERE timestamp IS NOT NULL)"""

# the update log: a window is written in every batch that touches it, with all rows so far
STREAM_LOG = """g AS (SELECT DISTINCT ws, coin_id, b FROM x),
 st AS (SELECT g.ws, g.coin_id, g.b, avg(x.price_usd) AS a, min(x.price_usd) AS mi, max(x.price_usd) AS ma,
               sum(x.volume_24h) AS v
        FROM g JOIN x ON x.ws = g.ws AND x.coin_id = g.coin_id AND x.b <= g.b
        GROUP BY g.ws, g.coin_id, g.b)"""


def _stored(prefix=""):
    return ", ".join([_dec(f"{prefix}a", 20, 8, "avg_price"), _dec(f"{prefix}mi", 20, 8, "min_price"),
                      _dec(f"{prefix}ma", 20, 8, "max_price"), _dec(f"{prefix}v", 20, 2, "total_volume")])


def stream_raw_prices() -> str:
    return f"""WITH {PRICES}
SELECT event_id, coin_id, {_dec('price_usd', 30, 8, 'price_usd')}, {_dec('market_cap', 30, 2, 'market_cap')},
       {_dec('volume_24h', 30, 2, 'volume_24h')}, date_trunc('second', timestamp) AS timestamp
FROM p"""


def stream_rejects() -> str:
    return f"""SELECT event_id, 'not json' AS raw, b AS batch_id
FROM (SELECT event_id, {PLACE} AS b FROM events) WHERE event_id % 7 = 0"""


def stream_market_metrics() -> str:
    return f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS message_key,
       l_returnflag || l_linestatus AS coin_id,
       {_dec('l_discount * 100', 20, 8, 'price_change_24h')}, {_dec('l_tax * 100', 20, 8, 'market_cap_change_24h')},
       {_dec('l_extendedprice', 20, 8, 'volume_change_24h')}, date_trunc('second', l_shipdate) AS timestamp
FROM lineitem"""


def stream_price_windows_log() -> str:
    return f"""WITH {PRICES}, {STREAM_X}, {STREAM_LOG}
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, coin_id, {_stored()}, b AS batch_id
FROM st"""


def stream_price_windows_latest() -> str:
    return f"""WITH {PRICES}, {WIN}, {BATCH_AGG}
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, coin_id, {_stored()}
FROM bt"""


def stream_price_windows_watermark() -> str:
    return f"""WITH {PRICES}, {WIN}, {BATCH_AGG}
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, coin_id, {_stored()}
FROM bt
WHERE ws + INTERVAL 15 MINUTE <= (SELECT date_trunc('second', max(ts)) FROM events) - INTERVAL 30 MINUTE"""


def _diffs(s):
    return f"""round(CAST(CAST({s}.a AS DECIMAL(20,8)) AS DOUBLE) - bt.a, 6) + 0.0 AS avg_price_diff,
       round(CAST(CAST({s}.mi AS DECIMAL(20,8)) AS DOUBLE) - bt.mi, 6) + 0.0 AS min_price_diff,
       round(CAST(CAST({s}.ma AS DECIMAL(20,8)) AS DOUBLE) - bt.ma, 6) + 0.0 AS max_price_diff,
       round(CAST(CAST({s}.v AS DECIMAL(20,2)) AS DOUBLE) - bt.v, 6) + 0.0 AS volume_diff"""


def compare_stream_batch_log() -> str:
    return f"""WITH {PRICES}, {STREAM_X}, {STREAM_LOG}, {BATCH_AGG}
SELECT st.ws AS window_start, st.ws + INTERVAL 15 MINUTE AS window_end, st.coin_id, {_diffs('st')}
FROM st JOIN bt ON st.ws = bt.ws AND st.coin_id = bt.coin_id"""


def compare_stream_batch_latest() -> str:
    return f"""WITH {PRICES}, {WIN}, {BATCH_AGG}
SELECT bt.ws AS window_start, bt.ws + INTERVAL 15 MINUTE AS window_end, bt.coin_id, {_diffs('bt')}
FROM bt"""


def consistency_summary() -> str:
    return f"""WITH {PRICES}, {STREAM_X}, {STREAM_LOG},
 s AS (SELECT {exact_avg('CAST(CAST(a AS DECIMAL(20,8)) AS DOUBLE)')} AS sp,
              {exact_avg('CAST(CAST(v AS DECIMAL(20,2)) AS DOUBLE)')} AS sv, count(*) AS n FROM st),
 b AS (SELECT {exact_avg('price_usd')} AS bp, {exact_avg('volume_24h')} AS bv, count(*) AS n FROM p)
SELECT abs((sp - bp) / bp * 100) AS price_difference_percent,
       abs((sv - bv) / bv * 100) AS volume_difference_percent,
       s.n AS streaming_records, b.n AS batch_records
FROM s, b"""


def trending_coins() -> str:
    return f"""WITH a AS ({market_avg_changes()})
SELECT * FROM a ORDER BY avg_price_change DESC, coin_id LIMIT 3"""


def volume_rank() -> str:
    return f"""WITH {PRICES}, {WIN}, {BATCH_EXACT}
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, coin_id, v AS total_volume,
       CAST(rank() OVER (PARTITION BY ws ORDER BY v DESC) AS INTEGER) AS volume_rank
FROM bt"""


def market_trend() -> str:
    return f"""WITH {PRICES}, {WIN}, {BATCH_EXACT},
 r AS (SELECT coin_id, ws AS window_start, round(a, 6) + 0.0 AS avg_price FROM bt),
 l AS (SELECT *, lag(avg_price) OVER (PARTITION BY coin_id ORDER BY window_start) AS prev_avg_price FROM r)
SELECT coin_id, window_start, avg_price, prev_avg_price,
       round((avg_price - prev_avg_price) / prev_avg_price * 100, 4) + 0.0 AS pct_change,
       CASE WHEN prev_avg_price IS NULL THEN 'new' WHEN avg_price > prev_avg_price THEN 'up'
            WHEN avg_price < prev_avg_price THEN 'down' ELSE 'flat' END AS trend
FROM l"""


def encode_price_messages() -> str:
    return f"""WITH {PRICES}
SELECT event_id, 'prices' AS topic,
       CAST(to_json(struct_pack(coin_id := coin_id, price_usd := price_usd, market_cap := market_cap,
                           volume_24h := volume_24h, timestamp := epoch_us(timestamp) // 1000)) AS VARCHAR) AS value
FROM p"""


# windows over the prices as the raw sink stores them
STORED_WIN = """y AS (
  SELECT coin_id, CAST(price_usd AS DECIMAL(30,8)) AS price_usd, CAST(volume_24h AS DECIMAL(30,2)) AS volume_24h,
         time_bucket(INTERVAL 5 MINUTE, timestamp) - k * INTERVAL 5 MINUTE AS ws
  FROM p, range(3) r(k) WHERE timestamp IS NOT NULL),
 sb AS (SELECT ws, coin_id, avg(CAST(price_usd AS DOUBLE)) AS a, CAST(min(price_usd) AS DOUBLE) AS mi,
               CAST(max(price_usd) AS DOUBLE) AS ma, CAST(sum(volume_24h) AS DOUBLE) AS v FROM y GROUP BY ws, coin_id)"""


def _compare_stored(source: str) -> str:
    diffs = _diffs("st").replace("bt.", "sb.")
    return f"""WITH {PRICES}, {STREAM_X}, {STREAM_LOG}, {STORED_WIN}
SELECT st.ws AS window_start, st.ws + INTERVAL 15 MINUTE AS window_end, st.coin_id, {diffs}
FROM {source} st JOIN sb ON st.ws = sb.ws AND st.coin_id = sb.coin_id"""


def compare_stored_log() -> str:
    return _compare_stored("st")


def compare_stored_latest() -> str:
    return _compare_stored("(SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY ws, coin_id ORDER BY b DESC) = 1)")


def consistency_stored() -> str:
    return consistency_summary().replace(
        f"{exact_avg('price_usd')} AS bp, {exact_avg('volume_24h')} AS bv",
        f"{exact_avg('CAST(CAST(price_usd AS DECIMAL(30,8)) AS DOUBLE)')} AS bp, "
        f"{exact_avg('CAST(CAST(volume_24h AS DECIMAL(30,2)) AS DOUBLE)')} AS bv")


def _timed(sql: str, mode: str) -> str:
    return f"""SELECT '{mode}' AS mode, query, CAST(seq AS BIGINT) AS seq, rows,
       CAST(error_count AS BIGINT) AS error_count, true AS timed FROM ({sql})"""


def stream_metrics() -> str:
    mkt = """(SELECT (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1)
               // (SELECT (count(*) + 3) // 4 FROM lineitem) AS b FROM lineitem)"""
    return _timed(f"""WITH {PRICES}, {STREAM_X}
SELECT 'raw_prices' AS query, b AS seq, count(*) + count(*) FILTER (WHERE event_id % 7 = 0) AS rows,
       count(*) FILTER (WHERE event_id % 7 = 0) AS error_count
FROM (SELECT event_id, {PLACE} AS b FROM events) GROUP BY b
UNION ALL SELECT 'price_windows', b, count(DISTINCT (ws, coin_id)), 0 FROM x GROUP BY b
UNION ALL SELECT 'market_metrics', b, count(*), 0 FROM {mkt} GROUP BY b""", "streaming")


def stream_metrics_watermark() -> str:
    return f"""WITH {PRICES}, {STREAM_X}
SELECT 'streaming' AS mode, 'price_windows_live' AS query, count(DISTINCT (ws, coin_id, b)) AS rows,
       CAST(0 AS BIGINT) AS error_count FROM x
UNION ALL
SELECT 'streaming', 'price_windows_watermark', count(DISTINCT (ws, coin_id)), CAST(0 AS BIGINT)
FROM x WHERE ws + INTERVAL 15 MINUTE <= (SELECT date_trunc('second', max(ts)) FROM events) - INTERVAL 30 MINUTE"""


def stream_progress() -> str:
    return f"""WITH {PRICES}, {STREAM_X},
 e AS (SELECT b, count(*) + count(*) FILTER (WHERE event_id % 7 = 0) AS n
       FROM (SELECT event_id, {PLACE} AS b FROM events) GROUP BY b),
 f AS (SELECT ws, coin_id, min(b) AS b FROM x GROUP BY ws, coin_id)
SELECT 'raw_prices' AS query, CAST(b AS BIGINT) AS batch_id, n AS input_rows, CAST(0 AS BIGINT) AS state_rows,
       CAST(0 AS BIGINT) AS late_rows, true AS timed FROM e
UNION ALL SELECT 'price_windows', b, n, (SELECT count(*) FROM f WHERE f.b <= e.b), 0, true FROM e"""


# the late feed: chunks 0, 2, 1, 3 of the order of ids; the watermark that counts for a chunk is
# half an hour behind the latest second of the chunks that arrived before it
LATE = f"""q AS (
  SELECT p.*, date_trunc('second', timestamp) AS sec, CASE {PLACE} WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE {PLACE} END AS b FROM p),
 wm AS (SELECT c.b, (SELECT max(sec) FROM q WHERE q.b < c.b) - INTERVAL 30 MINUTE AS mark
        FROM (SELECT DISTINCT b FROM q) c),
 y AS (SELECT q.*, time_bucket(INTERVAL 5 MINUTE, sec) - k * INTERVAL 5 MINUTE AS ws, wm.mark
       FROM q JOIN wm ON wm.b = q.b, range(3) r(k) WHERE sec IS NOT NULL)"""


def stream_late_dropped() -> str:
    return f"""WITH {PRICES}, {LATE}
SELECT CAST(e.b AS BIGINT) AS arrival, e.n AS input_rows,
       (SELECT count(DISTINCT (ws, coin_id)) FROM y WHERE y.b = e.b AND ws + INTERVAL 15 MINUTE <= mark) AS late_rows
FROM (SELECT b, count(*) + count(*) FILTER (WHERE event_id % 7 = 0) AS n FROM q GROUP BY b) e"""


def stream_late_kept() -> str:
    return f"""WITH {PRICES}, {LATE}, bt AS (
  SELECT ws, coin_id, avg(price_usd) AS a, min(price_usd) AS mi, max(price_usd) AS ma, sum(volume_24h) AS v
  FROM y WHERE mark IS NULL OR ws + INTERVAL 15 MINUTE > mark GROUP BY ws, coin_id)
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, coin_id, {_stored()}
FROM bt"""


TRACKED_TABLE = """pk AS (SELECT coin_id, max(price_usd) AS peak FROM p GROUP BY coin_id),
 tr AS (SELECT coin_id, peak >= (SELECT avg(peak) FROM pk) AS high FROM pk)"""


def tracked_coins_table() -> str:
    return f"""WITH {PRICES}, {TRACKED_TABLE}
SELECT event_id, coin_id, price_usd, volume_24h, timestamp
FROM p WHERE coin_id IN (SELECT coin_id FROM tr WHERE high)"""


def stream_tracked() -> str:
    return f"""WITH {PRICES}, {TRACKED_TABLE}, {LATE}
SELECT event_id, q.coin_id, {_dec('price_usd', 30, 8, 'price_usd')}, sec AS timestamp, CAST(b AS BIGINT) AS batch_id
FROM q JOIN tr ON tr.coin_id = q.coin_id AND tr.high = (b < 2)"""


def stream_open_windows() -> str:
    return f"""WITH {PRICES}, {WIN}, {BATCH_AGG}
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, coin_id, {_r('a', 'avg_price')},
       mi AS min_price, ma AS max_price, {_r('v', 'total_volume')}
FROM bt
WHERE ws + INTERVAL 15 MINUTE > (SELECT date_trunc('second', max(ts)) FROM events) - INTERVAL 30 MINUTE"""


def batch_metrics() -> str:
    return _timed("""SELECT 'price_analysis' AS query, 0 AS seq, count(*) AS rows, 0 AS error_count FROM events
UNION ALL SELECT 'market_analysis', 1, count(*), 0 FROM lineitem
UNION ALL SELECT 'comparison', 2, count(*), 0 FROM events""", "batch")


def batch_metrics_failed() -> str:
    return _timed("""SELECT 'price_analysis' AS query, 0 AS seq, count(*) AS rows, 0 AS error_count FROM events
UNION ALL SELECT 'market_analysis', 1, 0, 1
UNION ALL SELECT 'comparison', 2, count(*), 0 FROM events""", "batch")


def batch_report() -> str:
    return """SELECT 'batch' AS mode, CAST(0 AS BIGINT) AS total_errors, true AS timed
UNION ALL SELECT 'streaming', count(*) FILTER (WHERE event_id % 7 = 0), true FROM events"""


def sink_overflow_prices() -> str:
    return f"""WITH {PRICES}
SELECT event_id, coin_id,
       CASE WHEN event_id % 13 <> 0 OR price_usd = 0 THEN CAST(CAST(price_usd AS DECIMAL(30,8)) AS DOUBLE) END AS price_usd,
       CAST(CAST(market_cap AS DECIMAL(30,2)) AS DOUBLE) AS market_cap,
       CAST(CAST(volume_24h AS DECIMAL(30,2)) AS DOUBLE) AS volume_24h,
       event_id % 13 = 0 AND price_usd > 0 AS is_reject
FROM p"""


def price_windows_by_arrival() -> str:
    arrived = "timestamp AS event_time, date_trunc('millisecond', timestamp) + (event_id * 7 % 1800) * INTERVAL 1 SECOND AS timestamp"
    return f"""WITH o AS (WITH {PRICES} SELECT * FROM p), p AS (SELECT * EXCLUDE (timestamp), {arrived} FROM o), {WIN}, {BATCH_EXACT}
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, coin_id,
       a AS avg_price, mi AS min_price, ma AS max_price, v AS total_volume
FROM bt"""


def all_sql() -> dict[str, str]:
    names = ["price_window_agg", "encode_price_messages", "decode_prices", "decode_rejects", "decode_market", "market_avg_changes",
             "tracked_coins", "top_market_cap", "flatten_simple_price", "flatten_markets", "sink_typed_prices",
             "metrics_report", "metrics_series", "metrics_nested_import",
             "stream_raw_prices", "stream_rejects", "stream_market_metrics", "stream_price_windows_log",
             "stream_price_windows_latest", "stream_price_windows_watermark", "compare_stream_batch_log",
             "compare_stream_batch_latest", "consistency_summary", "trending_coins", "volume_rank", "market_trend",
             "flatten_simple_price_rejects", "flatten_markets_rejects", "metrics_nested_rejects",
             "metrics_series_null_mode", "compare_stored_log", "compare_stored_latest", "consistency_stored",
             "stream_metrics", "stream_metrics_watermark", "batch_metrics", "stream_progress", "stream_late_dropped",
             "stream_late_kept", "tracked_coins_table", "stream_tracked", "stream_open_windows",
             "batch_metrics_failed", "batch_report", "sink_overflow_prices", "price_windows_by_arrival"]
    g = globals()
    out = {n: g[n]() for n in names}
    # the compacted latest view must equal the full one
    out["compare_bucketed"] = out["compare_stream_batch_latest"]
    out["batch_consistency"] = out["consistency_summary"]
    # neither late arrival nor caps on a micro-batch change what is stored in the end
    out["stream_late_windows"] = out["stream_price_windows_capped"] = out["stream_price_windows_latest"]
    out["stream_raw_prices_capped"] = out["stream_raw_prices"]
    out["stream_price_windows_live"] = out["stream_price_windows_latest"]
    out["stream_price_windows_latest_compacted"] = out["stream_price_windows_latest"]
    return out
