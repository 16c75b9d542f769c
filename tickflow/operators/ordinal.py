"""Position of each row inside its group, computed without a per-group task.

``row_number().over(Window.partitionBy(g).orderBy(o))`` sends a whole group
to one task; with a handful of groups (two processing modes, five coins) a
single task would hold a third or a half of the data.  Here the rows are
range-partitioned on (g, o), so a large group is spread over many
partitions; each partition numbers its rows locally and a small table of
per-(partition, group) counts gives every slice its offset.  The same path
is taken at every size, and NULL is a group like any other, as in a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tickflow.session import drop_scratch, scratch_path, temporary_scratch

# A range partition holds about this many rows at most.
ROWS_PER_PARTITION = 2_000_000


def ordinal(df: DataFrame, group_cols: list[str], order_cols: list[str], name: str = "idx",
            partitions: int | None = None) -> DataFrame:
    """Adds ``name``: 0-based position of the row within its group by ``order_cols``
    (NULLs first, as in ascending order).

    ``order_cols`` should order rows uniquely inside a group; rows that tie are
    numbered in any order.  Without ``group_cols`` the whole table is one group.

    ``df`` is evaluated once: it is written as it comes, its rows counted by
    that write, and the range bounds are sampled from the keys of what was
    written.  The number of partitions follows from the counted rows.  The
    numbered rows are written to the shared scratch folder, so a lost executor
    does not renumber them, and the first copy is removed.  The numbered copy
    is removed when the application ends (``session.release_scratch``).
    """
    spark = df.sparkSession
    keys = [*group_cols, *order_cols]
    pid, pos, at, first, rows = (f"__{name}_{c}" for c in ("pid", "pos", "at", "first", "rows"))
    seen = Observation()
    plain, path = scratch_path(spark, "ordinal-input"), temporary_scratch(spark, "ordinal")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(plain)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = partitions or max(least, -(-seen.get["rows"] // ROWS_PER_PARTITION))
    ranged = (spark.read.schema(df.schema).parquet(plain)
                .repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn(pid, F.spark_partition_id())
                .withColumn(pos, F.monotonically_increasing_id()))
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    drop_scratch(spark, plain)
    slices = ranged.groupBy(pid, *group_cols).agg(F.min(pos).alias(first), F.count(F.lit(1)).alias(rows))
    before = Window.partitionBy(*group_cols).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn(at, F.coalesce(F.sum(rows).over(before), F.lit(0))).drop(rows)
    renamed = slices.select(*[F.col(c).alias(f"__s_{c}") for c in (pid, *group_cols)], first, at)
    same = F.lit(True)
    for c in (pid, *group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    return (ranged.join(renamed, same)
            .withColumn(name, F.col(at) + F.col(pos) - F.col(first))
            .drop(pid, pos, at, first, *[f"__s_{c}" for c in (pid, *group_cols)]))
