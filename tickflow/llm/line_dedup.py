"""Repeated lines dropped from all documents but the first that holds them.

Documents are taken in batches.  A batch hashes its lines' keys once, keeps
the distinct 128-bit hashes with the smallest id that holds each in the batch
and deals them to shards by hash, one packet a shard: a line that a third of
all documents hold is one entry of each packet.  Per shard, the distinct hashes
of all packets get a minimal perfect hash (``perfect_hash``), which indexes arrays
of a fingerprint, the number of documents and the smallest id.  Packets probe
the arrays of their shard, the answers go back to their batch, and the batch
drops its lines.  No row is a line, and lines are never joined.

The number of shards follows from the bytes of all texts, so a shard's arrays
and packets stay bounded.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import stored
from tickflow.llm.perfect_hash import PerfectHash

# Fixed values of the contract: white space stripped from a line, shortest key.
STRIPPED = b" \t\n\x0b\x0c\r"
LEAST_POINTS = 10
# Text behind one shard (its packets and arrays take less), text and rows of one batch.
SHARD_BYTES = 16_000_000
BATCH_BYTES = 8_000_000
BATCH_ROWS = 5_000
# In place of an id: no document with an id holds the line.
NO_ID = np.iinfo(np.int64).max

PACKED = ("batch string, shard int, keys binary, least binary, holders binary, ids array<string>, "
          "texts array<binary>, refs binary")


def key_of(line: bytes) -> bytes | None:
    """Key of a line, None if it is too short to count."""
    key = line.strip(STRIPPED).lower()  # of bytes: A-Z only
    if len(key) < LEAST_POINTS or len(key) < 4 * LEAST_POINTS and len(key.decode("utf-8", "replace")) < LEAST_POINTS:
        return None
    return key


def pack_batch(name: str, shards: int, ids: list, texts: list) -> list[tuple]:
    """Packets of a batch, one a shard, and the row with its documents."""
    entry: dict[bytes, int] = {}      # hash -> entry
    of_line: dict[bytes, int] = {}    # line as written -> entry, -1 if it does not count
    refs, owner, counts = [], [], []
    for k, text in enumerate(texts):
        lines = text.split(b"\n")
        mine = []
        for line in lines:
            e = of_line.get(line)
            if e is None:
                key = key_of(line)
                e = -1 if key is None else entry.setdefault(hashlib.blake2b(key, digest_size=16).digest(), len(entry))
                of_line[line] = e
            mine.append(e)
        found = np.array(mine, dtype=np.int32)
        refs.append(found)
        held = np.unique(found[found >= 0])
        owner.append(held)
        counts.append(np.full(len(held), NO_ID if ids[k] is None else int(ids[k]), dtype=np.int64))
    n = len(entry)
    least = np.full(n, NO_ID, dtype=np.int64)
    at = np.concatenate(owner) if owner else np.zeros(0, dtype=np.int64)
    np.minimum.at(least, at, np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64))
    holders = np.bincount(at, minlength=n).astype(np.int64)
    keys = np.frombuffer(b"".join(entry), dtype=np.uint64).reshape(-1, 2)
    shard = (keys[:, 0] % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    place = np.empty(n, dtype=np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for s in np.unique(shard).tolist():
        part = order[bounds[s]:bounds[s + 1]]
        rows.append((name, s, keys[part].tobytes(), least[part].tobytes(), holders[part].tobytes(), None, None, None))
    lines_of = np.concatenate(refs)
    lines_of = np.where(lines_of >= 0, place[lines_of], -1) if n else lines_of
    rows.append((name, -1, None, None, None, ids, texts, lines_of.astype(np.int32).tobytes()))
    return rows


def packets(docs: DataFrame, shards: int) -> DataFrame:
    """Batches of ``docs`` (id as text, text as bytes) as PACKED rows: packets
    (shard >= 0) and one row of documents (shard -1)."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        task = f"{context.partitionId()}-{context.taskAttemptId()}"
        names = (f"{task}-{k}" for k in itertools.count())
        ids, texts, held = [], [], 0
        columns = [c.split()[0] for c in PACKED.split(", ")]

        def full():
            return pd.DataFrame(pack_batch(next(names), shards, ids, texts), columns=columns)
        for batch in batches:
            for doc, text in zip(batch.iloc[:, 0].tolist(), batch.iloc[:, 1].tolist()):
                text = bytes(text) if text is not None else b""
                if ids and (held + len(text) > BATCH_BYTES or len(ids) >= BATCH_ROWS):
                    yield full()
                    ids, texts, held = [], [], 0
                ids.append(doc)
                texts.append(text)
                held += len(text)
        if ids:
            yield full()
    return docs.mapInPandas(rows, PACKED)


INDEX = "shard int, sizes binary, taken binary, prints binary, counts binary, least binary"


def halves(blobs) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(b"".join(blobs), dtype=np.uint64).reshape(-1, 2)
    return keys[:, 0], keys[:, 1]


def build_index(packed: DataFrame) -> DataFrame:
    """One row a shard: a minimal perfect hash over the distinct line hashes
    and, by its numbers, fingerprint (32 bits), number of documents and
    smallest id."""
    def one(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = halves(frame["keys"])
        least = np.frombuffer(b"".join(frame["least"]), dtype=np.int64)
        holders = np.frombuffer(b"".join(frame["holders"]), dtype=np.int64)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        least = np.minimum.reduceat(least[order], first)
        holders = np.add.reduceat(holders[order], first)
        a, b = a[first], b[first]
        perfect = PerfectHash.build(a, b)
        number = perfect.numbers(a, b)
        prints, counts, ids = np.empty(len(a), np.uint32), np.empty(len(a), np.int64), np.empty(len(a), np.int64)
        prints[number] = (b >> np.uint64(32)).astype(np.uint32)
        counts[number], ids[number] = holders, least
        return pd.DataFrame([(int(frame["shard"].iloc[0]), *perfect.packed(), prints.tobytes(), counts.tobytes(),
                              ids.tobytes())], columns=[c.split()[0] for c in INDEX.split(", ")])
    return packed.where("shard >= 0").select("shard", "keys", "least", "holders").groupBy("shard").applyInPandas(one, INDEX)


def probe(packed: DataFrame, index: DataFrame) -> DataFrame:
    """Per packet the smallest id of each of its lines held by two documents
    or more; NO_ID for others and for lines that the index does not hold."""
    def one(sent: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        if not len(arrays):  # an index of other documents may lack a shard
            nothing = [np.full(len(k) // 16, NO_ID, dtype=np.int64).tobytes() for k in sent["keys"]]
            return pd.DataFrame({"batch": sent["batch"].tolist(), "shard": sent["shard"].tolist(), "least": nothing})
        if not len(sent):
            return pd.DataFrame([], columns=["batch", "shard", "least"], dtype=object)
        row = arrays.iloc[0]
        perfect = PerfectHash.unpacked(row["sizes"], row["taken"])
        prints = np.frombuffer(row["prints"], dtype=np.uint32)
        counts, ids = (np.frombuffer(row[c], dtype=np.int64) for c in ("counts", "least"))
        out = []
        for keys in sent["keys"]:
            a, b = halves([keys])
            number = perfect.numbers(a, b)
            known = (number >= 0) & (prints[number] == (b >> np.uint64(32)).astype(np.uint32)) & (counts[number] > 1)
            out.append(np.where(known, ids[number], NO_ID).tobytes())
        return pd.DataFrame({"batch": sent["batch"].tolist(), "shard": sent["shard"].tolist(), "least": out})
    sent = packed.where("shard >= 0").select("batch", "shard", "keys")
    return sent.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(one, "batch string, shard int, least binary")


def drop_lines(packed: DataFrame, answers: DataFrame) -> DataFrame:
    """Documents of every batch without the lines that the answers take."""
    def one(batch: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        out = []
        least = np.frombuffer(b"".join(answer.sort_values("shard")["least"]) if len(answer) else b"", dtype=np.int64)
        for ids, texts, refs in zip(batch["ids"], batch["texts"], batch["refs"]):
            refs = np.frombuffer(refs, dtype=np.int32)
            home = np.append(least, NO_ID)[refs]  # -1: the entry behind the last
            at = 0
            for doc, text in zip(ids, texts):
                text = bytes(text)
                n = text.count(b"\n") + 1
                mine = home[at:at + n]
                at += n
                stays = (mine == NO_ID) | (mine == (NO_ID if doc is None else int(doc)))
                dropped = n - int(stays.sum())
                if dropped:
                    text = b"\n".join(itertools.compress(text.split(b"\n"), stays.tolist()))
                out.append((doc, n, dropped, text))
        return pd.DataFrame(out, columns=["id", "n_lines", "n_dropped", "text"])
    rows = packed.where("shard < 0").select("batch", "ids", "texts", "refs")
    return (rows.groupBy("batch").cogroup(answers.groupBy("batch"))
            .applyInPandas(one, "id string, n_lines long, n_dropped long, text binary"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per input row: id, ``n_lines`` (before), ``n_dropped`` and the
    kept ``text``.

    A text is split at newlines (null or empty: one empty line).  A line's key
    is the line stripped of the six ASCII white-space characters, A-Z lower-cased.
    All lines with a key of at least 10 code points that two documents or more
    hold go, except in the document of the smallest id that holds it.  Rows with
    the same id are one document in this.  A null id is larger than any other:
    its lines go where a document with an id has them, and stay where only
    documents without id have them.  Ids are whole numbers; other columns are
    not read; an empty table gives none.
    """
    d = docs.select(F.col(id_col).cast("long").cast("string").alias("id"),
                    F.col(text_col).cast("string").cast("binary").alias("text"))
    size = d.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = 1 + size // shard_bytes
    # batch names come from the attempt that wrote them, so packets and documents are read from this table only
    packed = stored(packets(d, shards), "line-packets")
    index = stored(build_index(packed), "line-index")
    answers = stored(probe(packed, index), "line-answers")
    kept = drop_lines(packed, answers)
    return kept.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_lines", "n_dropped",
                       F.col("text").cast("string").alias(text_col))
