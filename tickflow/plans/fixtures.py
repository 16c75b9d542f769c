"""The market relations, derived by Spark from the driver tables.

prices        <- events    (coin_id = event_type, price = value, ...)
market rows   <- lineitem  (coin_id = returnflag || linestatus, ...)
metrics log   <- lineitem  (mode by linestatus, rows = quantity, ...)

Every relation is a projection of a whole table, so its size grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions import messages as M
from tickflow.functions.arith import throughput
from tickflow.operators.cuts import in_shares
from tickflow.schemas import MODES
from tickflow.sources.tables import driver_table, spread

# Fixed values of the mapping.
REJECT_EVERY = 7          # every 7th event also yields one malformed message
REPLAY_CHUNKS = 4         # micro-batches a table is replayed in, at least
REPLAY_CHUNK_ROWS = 20_000_000
MALFORMED = "not json"


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, coin_id, price_usd, market_cap, volume_24h, timestamp (NTZ)."""
    e = driver_table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("event_type").alias("coin_id"),
        F.col("value").alias("price_usd"),
        (F.col("value") * 1000).alias("market_cap"),
        F.get_json_object("props", "$.k").cast("double").alias("volume_24h"),
        F.col("ts").alias("timestamp"),
    )


def market_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """l_orderkey, l_linenumber, coin_id, three changes, timestamp (NTZ)."""
    li = driver_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.concat("l_returnflag", "l_linestatus").alias("coin_id"),
        (F.col("l_discount") * 100).alias("price_change_24h"),
        (F.col("l_tax") * 100).alias("market_cap_change_24h"),
        F.col("l_extendedprice").alias("volume_change_24h"),
        F.col("l_shipdate").alias("timestamp"),
    )


def prices_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices with the stamp (epoch ms) of their arrival, up to half an hour
    after their event."""
    from tickflow.functions.timecols import ts_to_epoch_ms
    late = F.pmod(F.col("event_id") * 7, F.lit(1800)) * 1000
    return prices(spark, sf_dir).withColumn("ingest_ms", ts_to_epoch_ms("timestamp") + late)


# Every such event has a price that no stored column holds.
OVERFLOW_EVERY, OVERFLOW_BY = 13, 1e25


def overflowing_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of which every OVERFLOW_EVERY-th is too large for its column (unless it is 0)."""
    big = F.when(F.col("event_id") % OVERFLOW_EVERY == 0, F.col("price_usd") * OVERFLOW_BY).otherwise(F.col("price_usd"))
    return prices(spark, sf_dir).withColumn("price_usd", big)


PRICE_FIELDS = ["coin_id", "price_usd", "market_cap", "volume_24h", "timestamp"]
MARKET_FIELDS = ["coin_id", "price_change_24h", "market_cap_change_24h", "volume_change_24h", "timestamp"]


def price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded price messages keyed by event_id, plus one malformed copy for
    every ``REJECT_EVERY``-th event."""
    return _price_envelopes(prices(spark, sf_dir)).select("key", "value", "topic")


def _price_envelopes(p: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    good = M.encode(p, PRICE_FIELDS, key=F.col("event_id"), topic="prices", carry=("event_id", *carry))
    # one scan: each event yields its message and, for every REJECT_EVERY-th
    # event, a malformed copy (array_compact drops the NULL second entry)
    msg = F.struct("key", "value", "topic")
    bad = F.struct(F.col("key"), F.lit(MALFORMED).cast("binary").alias("value"), F.col("topic"))
    both = F.array_compact(F.array(msg, F.when(F.col("event_id") % REJECT_EVERY == 0, bad)))
    return good.select(*carry, F.inline(both))


def _staged_price_envelopes(p: DataFrame) -> DataFrame:
    """:func:`_price_envelopes` with ``chunk``, each task's rows in the order of
    their chunks: sorted while they are narrow, so that a write by chunk sorts no messages."""
    # true marks the malformed copy
    both = F.array_compact(F.array(F.lit(False), F.when(F.col("event_id") % REJECT_EVERY == 0, F.lit(True))))
    rows = p.select("*", F.explode(both).alias("_bad")).sortWithinPartitions("chunk")
    m = M.encode(rows, PRICE_FIELDS, key=F.col("event_id"), topic="prices", carry=("chunk", "_bad"))
    value = F.when(F.col("_bad"), F.lit(MALFORMED).cast("binary")).otherwise(F.col("value"))
    return m.select("chunk", "key", value.alias("value"), "topic")


def market_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded market messages keyed by 'orderkey-linenumber'."""
    return _market_envelopes(market_rows(spark, sf_dir))


def _market_envelopes(m: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return M.encode(m, MARKET_FIELDS, key=key, topic="market", carry=carry)


def replay_chunks(rows: int) -> int:
    """Micro-batches of a replay: REPLAY_CHUNKS, more once one would hold
    over REPLAY_CHUNK_ROWS rows."""
    return max(REPLAY_CHUNKS, -(-rows // REPLAY_CHUNK_ROWS))


def tracked_coin_table(spark: SparkSession, sf_dir: str, second_half: bool = False) -> DataFrame:
    """The tracked-coin table: coins whose highest price is at least the mean
    of the coins' highest prices; in the second half of a replay, the others."""
    peaks = prices(spark, sf_dir).groupBy("coin_id").agg(F.max("price_usd").alias("peak"))
    limit = F.broadcast(peaks.agg(F.avg("peak").alias("limit")))  # one row
    above = F.col("peak") >= F.col("limit")
    return peaks.join(limit, ~above if second_half else above).select("coin_id")


def late_order(chunks: int) -> list[int]:
    """Arrival of the chunks of a feed that is late: of each two neighbours
    after the first chunk the second arrives before the first."""
    order = list(range(chunks))
    for k in range(1, chunks - 1, 2):
        order[k], order[k + 1] = order[k + 1], order[k]
    return order


def replay_feed(spark: SparkSession, sf_dir: str, part: str) -> tuple[DataFrame, int]:
    """(messages with their ``chunk``, number of chunks) of a feed.

    Rows are dealt to equal chunks in the order of their ids (NULL first), so
    every row reaches a chunk, whatever its id, and no chunk holds more than its
    share.  Only rows near the cuts are sorted (``operators.cuts``).  The rows
    of a task come in the order of their chunks."""
    if part == "prices":
        rows, order = prices(spark, sf_dir), ["event_id"]
    else:
        rows, order = market_rows(spark, sf_dir), ["l_orderkey", "l_linenumber"]
    total = rows.count()
    chunks = replay_chunks(total)
    rows = in_shares(rows, order, total, chunks, "chunk")
    if part == "prices":
        return _staged_price_envelopes(rows), chunks
    return _market_envelopes(rows.sortWithinPartitions("chunk"), carry=("chunk",)), chunks


def metrics_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat metrics log (schemas.METRICS_RECORD) from lineitem."""
    li = driver_table(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_linestatus") == "O", "streaming").otherwise("batch").alias("mode"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("seq"),
        F.concat(F.lit("q"), "l_returnflag").alias("query"),
        F.col("l_orderkey").alias("batch_id"),
        F.col("l_quantity").alias("rows"),
        F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("processing_time"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("error_count"),
        (F.col("l_discount") * 100).alias("cpu_percent"),
        (F.col("l_tax") * 100).alias("memory_percent"),
        (F.col("l_quantity") / 100).alias("memory_used_gb"),
    )


def simple_price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object-keyed price payload per event: usd always, except every
    11th event; usd_market_cap absent for event_id % 5 = 0, null for % 5 = 1;
    usd_24h_vol absent for event_id % 3 = 0."""
    e = driver_table(spark, sf_dir, "events")
    i = F.col("event_id")
    entries = F.array_compact(F.array(
        F.when(i % 11 != 0, F.struct(F.lit("usd").alias("k"), F.col("value").alias("v"))),
        F.when(i % 5 != 0, F.struct(F.lit("usd_market_cap").alias("k"),
                                     F.when(i % 5 == 1, F.lit(None).cast("double"))
                                      .otherwise(F.col("value") * 2).alias("v"))),
        F.when(i % 3 != 0, F.struct(F.lit("usd_24h_vol").alias("k"),
                                     F.get_json_object("props", "$.k").cast("double").alias("v"))),
    ))
    inner = F.map_from_entries(entries)
    return e.select("event_id", F.to_json(F.create_map(F.col("event_type"), inner)).alias("payload"))


def markets_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array-of-objects market payloads, one per lineitem row, of two objects
    made from its columns: the second swaps the two flags and the two rates."""
    li = spread(driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_extendedprice"))

    def item(first, second, price, cap):
        return F.struct(F.concat(first, second).alias("id"), F.col(price).alias("price_change_percentage_24h"),
                        F.col(cap).alias("market_cap_change_percentage_24h"),
                        F.col("l_extendedprice").alias("total_volume"))

    items = F.array(item("l_returnflag", "l_linestatus", "l_discount", "l_tax"),
                    item("l_linestatus", "l_returnflag", "l_tax", "l_discount"))
    return li.select("l_orderkey", "l_linenumber", F.to_json(items).alias("payload"))


def broken_payloads(payloads: DataFrame, number: str) -> DataFrame:
    """Payloads in which every BROKEN_EVERY-th by ``number`` is no JSON."""
    return payloads.withColumn("payload", F.when(F.col(number) % BROKEN_EVERY == 0, F.lit(BROKEN))
                               .otherwise(F.col("payload")))


# The unparsable payload and how often it occurs.
BROKEN = "oops"
BROKEN_EVERY = 19


def nested_metrics_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested metrics documents (mode -> parallel lists), one per record of
    the metrics log: the record's mode holds the record and its repeat with
    twice the rows; the other mode holds the record where its error count is
    1, and is empty otherwise."""
    r = spread(metrics_records(spark, sf_dir))

    def entry(times):
        rows = F.col("rows") * times
        return F.struct(
            F.col("processing_time").alias("latency"),
            throughput(rows, F.col("processing_time")).alias("throughput"),
            F.col("error_count").alias("errors"),
            F.struct("cpu_percent", "memory_percent", "memory_used_gb").alias("resource_usage"),
            F.struct(F.when(F.col("mode") == "streaming", rows).alias("batch_size"),
                     F.when(F.col("mode") != "streaming", rows).alias("total_records"),
                     "processing_time", "error_count").alias("data_points"))

    def lists(m):
        own = F.array(entry(1), entry(2))
        other = F.when(F.col("error_count") == 1, F.array(entry(1))).otherwise(F.slice(own, 1, 0))
        return F.when(F.col("mode") == m, own).otherwise(other)

    r = r.select("seq", *[lists(m).alias(f"_{m}") for m in MODES])

    def columns(m):
        # field of an array of structs = the array of that field (codegen'd, no lambda)
        return F.struct(*[F.col(f"_{m}")[f].alias(f)
                          for f in ("latency", "throughput", "errors", "resource_usage", "data_points")])

    doc = F.create_map(*[x for m in MODES for x in (F.lit(m), columns(m))])
    return r.select(F.col("seq").alias("doc_id"), F.to_json(doc).alias("document"))
