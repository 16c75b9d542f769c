import datetime as dt

from pyspark.sql import functions as F

from tickflow.functions import messages as M
from tickflow.functions.timecols import as_instant, as_wallclock, epoch_ms_to_ts, ts_to_epoch_ms
from tickflow.schemas import CORRUPT_COL, PRICE_MESSAGE


def _msgs(spark, values):
    return spark.createDataFrame([(str(i).encode(), v.encode() if v is not None else None, "t")
                                  for i, v in enumerate(values)], "key binary, value binary, topic string")


def test_decode_valid_and_time_truncation(spark):
    m = _msgs(spark, ['{"coin_id":"a","price_usd":1.5,"market_cap":2,"volume_24h":3,"timestamp":1700000000999}'])
    r = M.decode(m, PRICE_MESSAGE).first()
    assert (r.coin_id, r.price_usd, r.market_cap, r.volume_24h) == ("a", 1.5, 2.0, 3.0)
    assert r.timestamp == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_malformed_is_all_null_and_rejected(spark):
    m = _msgs(spark, ["not json"])
    r = M.decode(m, PRICE_MESSAGE).first()
    assert all(r[c] is None for c in ("coin_id", "price_usd", "timestamp"))
    ok, bad = M.split_rejects(M.decode(m, PRICE_MESSAGE, with_corrupt=True))
    assert ok.count() == 0 and bad.first()[CORRUPT_COL] == "not json"


def test_wrong_type_keeps_other_fields_and_rejects(spark):
    m = _msgs(spark, ['{"coin_id":"b","price_usd":"x"}'])
    r = M.decode(m, PRICE_MESSAGE, with_corrupt=True).first()
    assert r.coin_id == "b" and r.price_usd is None and r[CORRUPT_COL] is not None


def test_null_value_is_rejected(spark):
    m = _msgs(spark, [None])
    ok, bad = M.split_rejects(M.decode(m, PRICE_MESSAGE, with_corrupt=True))
    assert ok.count() == 0 and bad.count() == 1


def test_missing_field_is_null_not_reject(spark):
    m = _msgs(spark, ['{"coin_id":"c","price_usd":1.0,"volume_24h":2,"timestamp":0}'])
    ok, bad = M.split_rejects(M.decode(m, PRICE_MESSAGE, with_corrupt=True))
    assert bad.count() == 0 and ok.first().market_cap is None


def test_time_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # inside the repeated autumn hour
        df = spark.range(1).select(F.lit(1699165800000).alias("ms"))
        r = df.select(epoch_ms_to_ts(F.col("ms")).alias("t")).select(
            "t", ts_to_epoch_ms(F.col("t")).alias("back"),
            ts_to_epoch_ms(as_wallclock(as_instant(F.col("t")))).alias("round_trip")).first()
        assert r.t == dt.datetime(2023, 11, 5, 6, 30) and r.back == 1699165800000 == r.round_trip
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_encode_round_trip(spark):
    df = spark.createDataFrame([("a", 1.25, None, 3.0, dt.datetime(2024, 1, 1, 0, 0, 1))],
                               "coin_id string, price_usd double, market_cap double, volume_24h double, "
                               "timestamp timestamp_ntz")
    e = M.encode(df, ["coin_id", "price_usd", "market_cap", "volume_24h", "timestamp"], key=F.lit(7), topic="p")
    v = e.first().value.decode()
    assert '"market_cap":null' in v and '"timestamp":1704067201000' in v
    back = M.decode(e, PRICE_MESSAGE).first()
    assert back.price_usd == 1.25 and back.timestamp == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_simple_price_payload_defaults(spark):
    p = spark.createDataFrame([
        (1, '{"a":{"usd":1.0}}'),
        (2, '{"b":{"usd":2.0,"usd_market_cap":null,"usd_24h_vol":5}}'),
        (3, '{"c":{}, "d":{"usd":4.0,"usd_market_cap":8}}'),
    ], "id int, payload string")
    rows = {r.coin_id: r for r in M.flatten_simple_price(p, keep=("id",)).collect()}
    assert set(rows) == {"a", "b", "d"}              # c has no usd: rejected alone
    assert rows["a"].market_cap == 0.0 and rows["a"].volume_24h == 0.0
    assert rows["b"].market_cap is None and rows["b"].volume_24h == 5.0
    assert rows["d"].market_cap == 8.0


def test_markets_payload(spark):
    p = spark.createDataFrame([(1, '[{"id":"x","price_change_percentage_24h":1.5,'
                                   '"market_cap_change_percentage_24h":-2,"total_volume":9},{"id":"y"}]')],
                              "id int, payload string")
    rows = {r.coin_id: r for r in M.flatten_markets(p, keep=("id",)).collect()}
    assert rows["x"].price_change_24h == 1.5 and rows["x"].volume_change_24h == 9.0
    assert rows["y"].market_cap_change_24h is None


def test_payload_rejects_are_returned(spark):
    from tickflow.functions.messages import markets_rejects, simple_price_rejects
    from tickflow.operators.metrics import nested_rejects
    p = spark.createDataFrame([(1, '{"a":{"usd":1.0},"b":{"eur":2.0}}'), (2, "oops"), (3, None), (4, "{}")],
                              "id int, payload string")
    got = {(r.id, r.coin_id, r.raw) for r in simple_price_rejects(p, keep=("id",)).collect()}
    assert got == {(1, "b", None), (2, None, "oops"), (3, None, None)}
    m = spark.createDataFrame([(1, '[{"id":"x"}]'), (2, "oops"), (3, None)], "id int, payload string")
    assert {r.id for r in markets_rejects(m, keep=("id",)).collect()} == {2, 3}
    d = spark.createDataFrame([(1, '{"batch":{"latency":[]}}'), (2, "oops")], "id int, document string")
    assert {r.id for r in nested_rejects(d, keep=("id",)).collect()} == {2}


def test_epoch_division_is_exact_beyond_doubles(spark):
    from tickflow.functions.timecols import epoch_ms_to_ts, ts_to_epoch_ms
    ms = [9_223_372_036_854_000, -1, -1001, 0, 253402300799999]
    df = spark.createDataFrame([(x,) for x in ms], "ms long").where("ms < 300000000000000")
    got = {r.ms: r.back for r in df.select("ms", ts_to_epoch_ms(epoch_ms_to_ts("ms")).alias("back")).collect()}
    assert got == {x: x // 1000 * 1000 for x in ms if x < 300_000_000_000_000}


def test_publish_writes_envelopes(spark, tmp_root):
    from tickflow.schemas import ENVELOPE
    from tickflow.streaming.sinks import publish, read_sink
    m = spark.createDataFrame([(b"k", b"v", "t")], ENVELOPE)
    publish(m, "parquet", path=tmp_root)
    publish(m, "parquet", path=tmp_root)
    assert read_sink(spark, tmp_root, ENVELOPE).count() == 2
    assert read_sink(spark, tmp_root + "-none", ENVELOPE).count() == 0
