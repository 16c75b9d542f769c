"""Connected components over a table of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import dropped, stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``a``, ``b``,
    both of type long); ``component`` is the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours and
    then the label of that label, so long chains shorten by more than half a
    round.  Labels are written to the shared folder between rounds; the only
    value that reaches the driver is the number of labels that changed.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.min("b").alias("least"))
                    .select("node", F.least("node", "least").alias("component")), "labels")
    written = labels
    while True:
        near = (both.join(labels, F.col("b") == F.col("node"))
                .groupBy("a").agg(F.min("component").alias("near")))
        step = (labels.join(near, F.col("node") == F.col("a"))
                .select("node", F.col("component").alias("was"), F.least("component", "near").alias("now")))
        up = labels.select(F.col("node").alias("now"), F.col("component").alias("above"))
        jumped = stored(step.join(up, "now").select("node", "was", F.least("now", "above").alias("component")), "labels")
        changed = jumped.where("component <> was").limit(1).count()
        dropped(written)
        written, labels = jumped, jumped.select("node", "component")
        if not changed:
            dropped(both)
            return labels
