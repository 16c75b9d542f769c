"""Message decoding, encoding and API payload shaping (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.timecols import epoch_ms_to_ts, ts_to_epoch_ms
from tickflow.schemas import CORRUPT_COL


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])


def decode(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ("key",),
           time_field: str | None = "timestamp", with_corrupt: bool = False) -> DataFrame:
    """Decode the JSON ``value`` column into typed columns.

    Permissive: a malformed message gives an all-NULL row and a wrong-typed
    field gives NULL in that field.  ``time_field`` (epoch ms) becomes a UTC
    timestamp truncated to the second.  With ``with_corrupt`` the raw text of
    each undecodable message is kept in ``_corrupt_record``.
    """
    sch = _with_corrupt(schema) if with_corrupt else schema
    opts = {"mode": "PERMISSIVE"}
    if with_corrupt:
        opts["columnNameOfCorruptRecord"] = CORRUPT_COL
    text = F.col("value").cast("string")
    kept = [k for k in keep if k in df.columns]
    # The parsed struct is expanded by a one-element generator: a later filter
    # on a decoded field (rejects, window's non-NULL time) cannot be pushed
    # below a generator's output, so each message is parsed exactly once
    # instead of once in the pushed-down filter and again in the projection.
    out = df.select(*kept, text.isNull().alias("_no_value"), F.inline(F.array(F.from_json(text, sch, opts))))
    if with_corrupt:
        # A NULL value is not caught by the corrupt-record column.
        out = out.withColumn(CORRUPT_COL, F.when(F.col("_no_value"), F.lit("")).otherwise(F.col(CORRUPT_COL)))
    out = out.drop("_no_value")
    if time_field:
        out = out.withColumn(time_field, epoch_ms_to_ts(F.col(time_field)))
    return out


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of a frame decoded ``with_corrupt``.

    Both are filters over the same plan; write them in one pass with
    ``flag_rejects`` when the input must be read once."""
    bad = F.col(CORRUPT_COL).isNotNull()
    return decoded.filter(~bad).drop(CORRUPT_COL), decoded.filter(bad)


def flag_rejects(decoded: DataFrame) -> DataFrame:
    """Adds ``is_reject`` so valid and rejected rows go out in a single write."""
    return decoded.withColumn("is_reject", F.col(CORRUPT_COL).isNotNull())


def encode(df: DataFrame, fields: list[str], key: Column | None = None,
           topic: str | None = None, time_field: str | None = "timestamp",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows to message envelopes: ``value`` is the JSON object of ``fields``
    (NULL fields written as null), ``time_field`` as epoch milliseconds.
    ``carry`` columns are passed through unchanged."""
    cols = [ts_to_epoch_ms(F.col(f)).alias(f) if f == time_field else F.col(f) for f in fields]
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return df.select(
        (key.cast("string").cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).cast("string").alias("topic"),
        *carry,
    )


SIMPLE_PRICE_PAYLOAD = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))


def flatten_simple_price(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Object-keyed price payload ``{coin: {usd, usd_market_cap?, usd_24h_vol?}}``
    to one row per coin.  A missing market cap or volume key defaults to 0, an
    explicit null stays NULL; entries without ``usd`` and payloads that do not
    parse are given by :func:`simple_price_rejects`."""
    m = F.col("_v")
    def opt(k):
        return F.when(F.map_contains_key(m, k), m[k]).otherwise(F.lit(0.0))
    rows = df.select(*keep, F.explode(F.from_json(F.col(payload), SIMPLE_PRICE_PAYLOAD)).alias("coin_id", "_v"))
    return (rows.filter(F.map_contains_key(m, "usd"))
                .select(*keep, "coin_id", m["usd"].alias("price_usd"),
                        opt("usd_market_cap").alias("market_cap"),
                        opt("usd_24h_vol").alias("volume_24h")))


MARKETS_PAYLOAD = T.ArrayType(T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("price_change_percentage_24h", T.DoubleType()),
    T.StructField("market_cap_change_percentage_24h", T.DoubleType()),
    T.StructField("total_volume", T.DoubleType()),
]))


def simple_price_rejects(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """What :func:`flatten_simple_price` gives no row for: ``coin_id`` of an
    entry without ``usd``, or NULL with the ``raw`` text of a payload that
    does not parse (or is NULL)."""
    parsed = F.from_json(F.col(payload), SIMPLE_PRICE_PAYLOAD)
    d = df.select(*keep, F.col(payload).alias("raw"), F.inline(F.array(F.struct(parsed.alias("m")))))
    entries = d.select(*keep, "raw", "m", F.explode_outer("m").alias("coin_id", "_v"))
    lost = F.col("m").isNull() | ~F.coalesce(F.map_contains_key("_v", "usd"), F.lit(True))
    return entries.filter(lost).select(
        *keep, "coin_id", F.when(F.col("m").isNull(), F.col("raw")).alias("raw"))


def markets_rejects(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Payloads that :func:`flatten_markets` gives no row for because they do
    not parse (or are NULL)."""
    parsed = F.from_json(F.col(payload), MARKETS_PAYLOAD)
    d = df.select(*keep, F.col(payload).alias("raw"), F.inline(F.array(F.struct(parsed.alias("m")))))
    return d.filter(F.col("m").isNull()).select(*keep, "raw")


def flatten_markets(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Array-of-objects market payload to one market row per element."""
    m = df.select(*keep, F.explode(F.from_json(F.col(payload), MARKETS_PAYLOAD)).alias("_m"))
    return m.select(*keep,
                    F.col("_m.id").alias("coin_id"),
                    F.col("_m.price_change_percentage_24h").alias("price_change_24h"),
                    F.col("_m.market_cap_change_percentage_24h").alias("market_cap_change_24h"),
                    # the publisher puts the absolute 24 h volume here
                    F.col("_m.total_volume").alias("volume_change_24h"))
