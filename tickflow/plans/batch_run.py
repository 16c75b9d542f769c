"""The batch application: the three analyses over stored tables, each written
once and timed, with one batch-mode metrics record per analysis (K5); as the
last step, the report over all metrics and the consistency of both sides."""

from __future__ import annotations

import time
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickflow.operators import reconcile as R
from tickflow.operators import windows as W
from tickflow.operators.market import avg_changes
from tickflow.operators.metrics import report
from tickflow.schemas import METRICS_RECORD


def timed_write(name: str, seq: int, source: DataFrame, result_of, out_path: str | None) -> DataFrame:
    """Runs ``result_of(source)`` once (to ``out_path`` or a noop sink) and
    returns its metrics record.  Input rows are counted by an observation on
    the source during that same execution, so the input is not scanned twice.

    An analysis that fails is warned of and recorded with one error and no
    rows, and the ones after it still run."""
    obs = Observation(f"batch_{name}_{seq}")
    t0 = time.time()
    rows, errors = 0.0, 0
    try:
        res = result_of(source.observe(obs, F.count(F.lit(1)).alias("rows")))
        w = res.write.mode("overwrite")
        w.parquet(out_path) if out_path else w.format("noop").save()
        rows = float(obs.get["rows"])
    except (PySparkException, Py4JJavaError, ValueError) as e:  # also the guard against missing columns
        errors = 1
        warnings.warn(f"batch analysis {name} failed: {e}", stacklevel=2)
    seconds = time.time() - t0
    row = ("batch", seq, name, None, rows, seconds, errors, None, None, None)
    spark = source.sparkSession
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name)
                                   for v, f in zip(row, METRICS_RECORD.fields)])


def run_batch(spark: SparkSession, prices: DataFrame, market: DataFrame, stream_windows: DataFrame,
              out_root: str | None = None) -> DataFrame:
    """Price windows (A1), market averages (A3) and the stream/batch
    comparison (J1) in call order; returns their metrics records."""
    def out(n):
        return f"{out_root}/{n}" if out_root else None
    recs = [
        timed_write("price_analysis", 0, prices, W.pane_windowed, out("price_windows")),
        timed_write("market_analysis", 1, market, avg_changes, out("market_averages")),
        timed_write("comparison", 2, prices, lambda p: R.compare_windows(stream_windows, W.windowed(p)),
                    out("comparison")),
    ]
    res = recs[0]
    for r in recs[1:]:
        res = res.unionByName(r)
    return res


def run_application(spark: SparkSession, prices: DataFrame, market: DataFrame, stream_windows: DataFrame,
                    out_root: str, stream_metrics: DataFrame | None = None) -> dict[str, DataFrame]:
    """The whole batch application: :func:`run_batch`, then, as its last step,
    the report over its metrics and those of the streams (A6) and the
    consistency of stored windows and prices (J2).  All is written under
    ``out_root``; returns ``metrics``, ``report`` and ``consistency`` read back."""
    run_batch(spark, prices, market, stream_windows, out_root).write.mode("overwrite").parquet(f"{out_root}/metrics")
    metrics = spark.read.schema(METRICS_RECORD).parquet(f"{out_root}/metrics")
    both = metrics if stream_metrics is None else metrics.unionByName(stream_metrics)
    last = {"report": report(both), "consistency": R.consistency(stream_windows, prices)}
    out = {"metrics": metrics}
    for name, df in last.items():
        df.write.mode("overwrite").parquet(f"{out_root}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{out_root}/{name}")
    return out
