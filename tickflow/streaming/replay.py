"""Replay a table through the streaming queries in deterministic micro-batches.

Chunk k of every feed is appended to the feed's inbox (a folder under the
shared checkpoint root), then the queries run with ``availableNow`` on their
persistent checkpoints, so chunk k is exactly micro-batch k of each query.
The restart between chunks is also the restart-from-checkpoint path: each
query resumes from its committed offsets and state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickflow.session import move_files

from tickflow.streaming.queries import await_all


def replay(spark: SparkSession, feeds: list[tuple[Callable[[int], DataFrame | str], str]], n_chunks: int,
           start: Callable[[], list[StreamingQuery]],
           on_batch: Callable[[list[StreamingQuery]], None] | None = None) -> None:
    """For k in 0..n_chunks-1: append ``chunk(k)`` of every feed to its inbox,
    then run ``start()``'s queries (built with ``trigger(availableNow=True)``)
    to completion.  A chunk is a frame (one distributed write) or the path of
    a written folder, whose files are moved into the inbox."""
    for k in range(n_chunks):
        for chunk, inbox in feeds:
            part = chunk(k)
            if isinstance(part, str):
                move_files(spark, part, inbox)
            else:
                part.write.mode("append").parquet(inbox)
        qs = start()
        await_all(spark, qs)
        if on_batch:
            on_batch(qs)
