"""Analyses the README promises without code; the definitions are ours.

E1 trending coins, E2 volume rank inside a window, E3 trend against the
previous non-empty window of the same coin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.arith import round_double
from tickflow.session import temporary_scratch


def trending(avg_changes: DataFrame, k: int = 3) -> DataFrame:
    """The k coins with the largest mean price change, ties by coin_id."""
    return avg_changes.orderBy(F.desc("avg_price_change"), F.asc("coin_id")).limit(k)


def volume_rank(windows: DataFrame) -> DataFrame:
    """Rank of each coin by total volume inside its window (1 = largest).
    Volumes are compared in their stored type, so that ties do not depend on
    the order in which a double was summed.  A window holds one row per coin,
    so each window partition stays small."""
    w = Window.partitionBy("window_start", "window_end").orderBy(F.expr("try_cast(total_volume AS DECIMAL(20, 2))").desc())
    return windows.select("window_start", "window_end", "coin_id", "total_volume",
                          F.rank().over(w).alias("volume_rank"))


def previous_value(df: DataFrame, key: str, order_col: str, value_col: str, prev_col: str,
                   bucket: str = "day") -> DataFrame:
    """``lag(value_col)`` over (partition by key order by order_col), without
    putting a whole key in one task: rows are numbered inside (key, time
    bucket) partitions, and the first row of a bucket takes the last value of
    the key's latest earlier bucket from a per-(key, bucket) table."""
    b = F.date_trunc(bucket, F.col(order_col)).cast("timestamp_ntz")
    d = df.withColumn("_b", b)
    inner = Window.partitionBy(key, "_b").orderBy(order_col)
    d = d.withColumn("_prev", F.lag(value_col).over(inner)) \
         .withColumn("_n", F.row_number().over(inner))
    # both branches below read ``d``: it is written once to the shared scratch
    # folder, or each branch would rescan and re-aggregate the input; the copy
    # goes when the application ends
    path = temporary_scratch(d.sparkSession, "previous")
    d.write.parquet(path)
    d = d.sparkSession.read.schema(d.schema).parquet(path)
    last = d.groupBy(key, "_b").agg(F.max_by(value_col, "_n").alias("_last"))
    across = Window.partitionBy(key).orderBy("_b")
    last = last.select(key, "_b", F.lag("_last").over(across).alias("_carry"))
    last = last.select(F.col(key).alias("_key"), F.col("_b").alias("_bucket"), "_carry")
    out = d.join(last, F.col(key).eqNullSafe(F.col("_key")) & F.col("_b").eqNullSafe(F.col("_bucket")), "left")
    return out.withColumn(prev_col, F.when(F.col("_n") == 1, F.col("_carry")).otherwise(F.col("_prev"))) \
              .drop("_b", "_prev", "_n", "_carry", "_key", "_bucket")


def market_trend(windows: DataFrame, scale: int = 6) -> DataFrame:
    """Percent change of a coin's average price from its previous
    non-empty window (4 places) and a label up / down / flat ('new' for the
    first window).  Prices are compared rounded to ``scale`` places."""
    w = windows.select("coin_id", "window_start", round_double(F.col("avg_price"), scale).alias("avg_price"))
    p = previous_value(w, "coin_id", "window_start", "avg_price", "prev_avg_price")
    change = F.round(F.try_divide(F.col("avg_price") - F.col("prev_avg_price"), F.col("prev_avg_price")) * 100, 4)
    label = (F.when(F.col("prev_avg_price").isNull(), "new")
              .when(F.col("avg_price") > F.col("prev_avg_price"), "up")
              .when(F.col("avg_price") < F.col("prev_avg_price"), "down").otherwise("flat"))
    return p.select("coin_id", "window_start", "avg_price", "prev_avg_price",
                    (change + F.lit(0.0)).alias("pct_change"), label.alias("trend"))
