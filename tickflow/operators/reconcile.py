"""Stream-versus-batch reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions import exact
from tickflow.functions.arith import percent_diff
from tickflow.operators.windows import WINDOW_KEYS

DIFF_COLUMNS = ["avg_price_diff", "min_price_diff", "max_price_diff", "volume_diff"]


def compare_windows(stream: DataFrame, batch: DataFrame) -> DataFrame:
    """Inner equi-join of stored stream windows with recomputed batch windows
    on (window_start, window_end, coin_id); stream minus batch per measure.

    Windows present on one side only drop out; several stream rows of one
    window (an update log) each give a row.  Both sides are large and keyed
    alike, so this is a shuffle (or AQE broadcast) join on the three keys; a
    hot coin is spread over its many windows.
    """
    s = stream.select(*WINDOW_KEYS, *[F.col(c).alias(f"s_{c}") for c in
                                      ("avg_price", "min_price", "max_price", "total_volume")])
    b = batch.select(*WINDOW_KEYS, *[F.col(c).alias(f"b_{c}") for c in
                                     ("avg_price", "min_price", "max_price", "total_volume")])
    j = s.join(b, WINDOW_KEYS, "inner")
    return j.select(*WINDOW_KEYS,
                    (F.col("s_avg_price") - F.col("b_avg_price")).alias("avg_price_diff"),
                    (F.col("s_min_price") - F.col("b_min_price")).alias("min_price_diff"),
                    (F.col("s_max_price") - F.col("b_max_price")).alias("max_price_diff"),
                    (F.col("s_total_volume") - F.col("b_total_volume")).alias("volume_diff"))


def consistency(stream_windows: DataFrame, prices: DataFrame) -> DataFrame:
    """One row: percent difference of the mean window average price and mean
    window volume against the mean raw price and volume, and both row counts.

    Both global aggregates run in a single job over the union of the two
    inputs (a side tag per row), so there is no join and nothing is collected;
    each task pre-aggregates.  Sums are exact, so the result does not depend on
    the partitioning.
    """
    s = stream_windows.select(F.lit(True).alias("_s"), F.col("avg_price").cast("double").alias("_p"),
                              F.col("total_volume").cast("double").alias("_v"))
    b = prices.select(F.lit(False).alias("_s"), F.col("price_usd").cast("double").alias("_p"),
                      F.col("volume_24h").cast("double").alias("_v"))
    both = exact.split(s.unionByName(b), p=F.col("_p"), v=F.col("_v"))
    g = both.groupBy("_s").agg(F.count(F.lit(1)).alias("n"), *exact.sums("p", "v"))
    g = g.select("_s", "n", exact.mean("p").alias("p"), exact.mean("v").alias("v"))
    # two rows at most: turned into one
    side = {"s": F.col("_s"), "b": ~F.col("_s")}
    g = g.agg(*[F.max(F.when(at, F.col(c))).alias(f"{k}{c}") for k, at in side.items() for c in "pv"],
              F.coalesce(F.max(F.when(F.col("_s"), F.col("n"))), F.lit(0)).alias("streaming_records"),
              F.coalesce(F.max(F.when(~F.col("_s"), F.col("n"))), F.lit(0)).alias("batch_records"))
    return g.select(percent_diff(F.col("sp"), F.col("bp")).alias("price_difference_percent"),
                    percent_diff(F.col("sv"), F.col("bv")).alias("volume_difference_percent"),
                    "streaming_records", "batch_records")
