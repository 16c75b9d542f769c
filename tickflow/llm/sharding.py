"""Balanced label propagation: shards of equal row counts that keep equal
texts together.

Documents of equal text are linked.  A group larger than half of a shard
is cut into blocks by a hash of its rows, so no group has to fit into one
shard.  Every row starts in a hashed shard.  In each round a block's rows are
counted by shard; the rows want to move to the shard that holds most of their
block.  Quotas follow from the 24 by 24 table of wanted moves: a shard admits
as many as it has room for once its own leavers are gone, and blocks are
admitted by a hash.  A shard that is over its quota in the end gives up rows of its
largest groups first, so whole small groups stay.  These rows, group by group,
and the rows without links then fill every shard to its exact count, so counts
differ by at most one.

Links are never listed as pairs: a block and its counts stand for all pairs
of its rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import stored
from tickflow.operators.ordinal import ordinal

SHARDS = 24
ROUNDS = 8
UNIT = 1 << 30


def quotas(rows: int, shards: int) -> np.ndarray:
    """Rows of each shard: equal, the first ones with one more."""
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], dtype=np.int64)


def admitted(load: np.ndarray, quota: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Share of the wanted moves into each shard that its quota allows.
    ``wanted[a, b]``: rows that want to move from a to b.  A shard's room
    grows with its own leavers, whose number depends on the other shards'
    shares: the shares start at one and shrink until all shards fit."""
    share = np.ones(len(load))
    come = wanted.sum(axis=0)
    for _ in range(200):
        leave = (wanted * share).sum(axis=1)
        room = np.maximum(0, quota - load + leave)
        now = np.minimum(share, np.where(come > 0, room / np.maximum(come, 1), 1.0))
        if np.allclose(now, share, atol=1e-6):
            break
        share = now
    return share


def propagate(rows: DataFrame, quota: np.ndarray, rounds: int) -> DataFrame:
    """Label propagation over linked rows (rid, g, n, blk, shard); ``n`` is the
    size of the group."""
    shards = len(quota)
    for turn in range(rounds):
        counts = rows.groupBy("g", "blk", "shard").agg(F.count(F.lit(1)).alias("n"))
        best = F.struct("n", F.xxhash64("g", "blk", "shard", F.lit(turn)).alias("h"), F.col("shard").alias("s"))
        goal = counts.groupBy("g", "blk").agg(F.max(best)["s"].alias("goal"))
        goal = stored(goal, "shard-goals")
        flow = (counts.join(goal, ["g", "blk"]).groupBy("shard", "goal").agg(F.sum("n").alias("n"))).collect()
        wanted, load = np.zeros((shards, shards)), np.zeros(shards)  # shards * shards rows at most
        for r in flow:
            load[r["shard"]] += r["n"]
            if r["shard"] != r["goal"]:
                wanted[r["shard"], r["goal"]] += r["n"]
        if not wanted.sum():
            break
        share = admitted(load, quota, wanted)
        limit = F.element_at(F.array(*[F.lit(int(x * UNIT)) for x in share]), F.col("goal") + 1)
        goal = goal.where(F.pmod(F.xxhash64("g", "blk", F.lit(turn + 1_000)), F.lit(UNIT)) < limit)
        rows = stored(rows.join(goal, ["g", "blk"], "left")
                      .select("rid", "g", "n", "blk", F.coalesce("goal", "shard").alias("shard")), "shard-labels")
    return rows


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``size`` (UTF-8 bytes plus 8), ``text_crc32``,
    ``law`` (``rows``: counts at most one apart), ``shard``, ``slot`` (gapless
    from 0 in each shard, by id) and ``grown_shard`` (null under this law).

    A null text counts as an empty one (size 8, checksum 0); empty texts are
    equal texts.  A null id stays null; repeated rows are linked like other
    equal texts; other columns are not read.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(docs[id_col].alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("g"))
    base = stored(base.withColumn("rid", F.monotonically_increasing_id()), "shard-rows")
    total = base.count()
    quota = quotas(total, shards)
    block = max(1, int(quota.min()) // 2)
    start = F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int")

    # written, so that the join below is one that Spark can split where a group is hot
    groups = stored(base.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shard-groups")
    blocks = F.ceil(F.col("n") / block)
    linked = (base.select("rid", "g").join(groups, "g")
              .select("rid", "g", "n", F.pmod(F.xxhash64("rid", F.lit(1)), blocks).alias("blk"), start.alias("shard")))
    linked = propagate(stored(linked, "shard-labels"), quota, rounds)

    # linked rows beyond a shard's count, of the largest groups first, join the rows without links, and these
    # fill the shards up
    held = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    over = {s: held.get(s, 0) - int(quota[s]) for s in range(shards) if held.get(s, 0) > quota[s]}
    if over:
        extra = F.element_at(F.array(*[F.lit(max(0, over.get(s, 0))) for s in range(shards)]), F.col("shard") + 1)
        placed = ordinal(linked.select("rid", "shard", (-F.col("n")).alias("size_down"), "g"),
                         ["shard"], ["size_down", "g", "rid"], "place")
        linked = placed.where(F.col("place") >= extra)
    kept = stored(linked.select("rid", "shard"), "shard-kept")
    free = base.select("rid", "g").join(kept, "rid", "left_anti")
    need = np.array([int(quota[s]) - min(held.get(s, 0), int(quota[s])) for s in range(shards)])
    ends = np.cumsum(need)
    shard = F.lit(shards - 1)
    for s in reversed(range(shards)):
        shard = F.when(F.col("place") < int(ends[s]), F.lit(s)).otherwise(shard)
    filled = ordinal(free, [], ["g", "rid"], "place").select("rid", shard.cast("int").alias("shard"))
    whole = base.select("doc_id", "size", "text_crc32", "rid").join(kept.unionByName(filled), "rid")
    return ordinal(whole, ["shard"], ["doc_id", "rid"], "slot").select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
