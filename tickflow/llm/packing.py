"""Variable-capacity best-fit packing of documents into training sequences.

A document's length is its number of words, or any other measure given (tokens,
bytes), plus one separator.  Documents
longer than the largest permitted capacity are cut into pieces.  Pieces are
dealt by a hash into blocks of bounded size, and each block is packed on its
own, longest first:

* a piece goes into the open bin that it leaves with the least room;
* if it fits nowhere, a bin is opened, of the capacity whose cost per word it
  will hold is least, given the piece and what is left of the block that
  could still go into it;
* at the end every bin shrinks to the least permitted capacity that holds its
  contents.

The cost of a sequence is linear in its capacity, plus a quadratic part for
attention and a fixed part for the sequence itself, so neither the longest
nor the shortest sequences always win.  The number of blocks grows with the
data; no block does.  Only ids and lengths are shuffled, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import id_back, id_text, stored, words

CAPACITIES = (512, 1024, 2048, 4096)
BLOCK_PIECES = 20_000
FIXED_COST = 64.0
QUADRATIC_COST = 1 / 16_384


def cost(capacity: int) -> float:
    return FIXED_COST + capacity + QUADRATIC_COST * capacity * capacity


def open_capacity(length: int, left: np.ndarray, capacities: tuple[int, ...]) -> int:
    """Capacity to open for a piece; ``left[x]``: words in pieces of length x
    not packed yet."""
    below = np.cumsum(left)

    def price(c):
        return cost(c) / min(c, length + int(below[min(c - length, len(below) - 1)]))

    return min((c for c in capacities if c >= length), key=lambda c: (price(c), c))


def pack(lengths: list[int], capacities: tuple[int, ...]) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset) of each piece, in order of non-increasing length, and the
    final capacity of each bin."""
    capacities = tuple(sorted(capacities))
    left = np.zeros(capacities[-1] + 1, dtype=np.int64)
    np.add.at(left, lengths, lengths)
    rooms: list[int] = []            # distinct amounts of room among open bins, ascending
    bins_with: dict[int, list[int]] = {}
    bin_of, offset, filled, opened = [], [], [], []
    for length in lengths:
        left[length] -= length
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            b = bins_with[room].pop()
            if not bins_with[room]:
                del bins_with[room], rooms[at]
        else:
            b = len(filled)
            room = open_capacity(length, left, capacities)
            filled.append(0)
            opened.append(room)
        bin_of.append(b)
        offset.append(filled[b])
        filled[b] += length
        room -= length
        if room:
            if room not in bins_with:
                insort(rooms, room)
                bins_with[room] = []
            bins_with[room].append(b)
    final = [next(c for c in capacities if c >= f) for f in filled]
    return bin_of, offset, final


def pieces(docs: DataFrame, most: int, id_col: str, text_col: str, length: Column | str | None = None) -> DataFrame:
    """(rid, doc_id, piece, start, length) of every document, in units of
    ``length`` (words if not given); the last piece of a document also holds
    its separator."""
    if length is None:
        size = F.size(words(docs[text_col].cast("string")))
    else:
        size = F.greatest(F.coalesce(docs[length] if isinstance(length, str) else length, F.lit(0)), F.lit(0))
    sized = docs.select(docs[id_col].alias("doc_id"), (size + 1).cast("long").alias("total"))
    sized = sized.withColumn("rid", F.monotonically_increasing_id())
    count = F.floor((F.col("total") + most - 1) / most)
    return (sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
            .select("rid", "doc_id", "piece", (F.col("piece") * most).alias("start"),
                    F.least(F.lit(most).cast("long"), F.col("total") - F.col("piece") * most).alias("length")))


def best_fit(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, block_pieces: int = BLOCK_PIECES,
             id_col: str = "doc_id", text_col: str = "text", length: Column | str | None = None) -> DataFrame:
    """One row per piece: id, ``piece`` (from 0), ``start`` and ``length`` in
    the unit packed by, ``bin`` (block * 2^32 + number in the block), ``bin_offset`` and
    ``bin_capacity``.

    ``length`` is a column of ``docs``, or an expression over it, with the
    length of each document in the unit of the capacities: token counts, or
    ``F.octet_length("text")``.  Documents are cut in that unit.  Without it
    the unit is words, which says little of a text without white space.

    A null or empty text (or a null length) has length 1, its separator, and is packed like any
    other; a null id stays null; repeated rows are packed once each; ties in
    length go by row; an empty table gives no rows; other columns are not read.
    """
    capacities = tuple(sorted(capacities))
    cut = stored(pieces(docs, capacities[-1], id_col, text_col, length), "pieces")
    blocks = max(1, -(-cut.count() // block_pieces))
    def packed(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "rid", "piece"], ascending=[False, True, True])
        bin_of, offset, final = pack(block["length"].tolist(), capacities)
        number = int(block["block"].iloc[0])
        return pd.DataFrame({
            "doc_id": block["doc_id"], "piece": block["piece"], "start": block["start"], "length": block["length"],
            "bin": [(number << 32) + b for b in bin_of], "bin_offset": offset,
            "bin_capacity": [final[b] for b in bin_of]})

    placed = (cut.withColumn("doc_id", id_text(cut, "doc_id")).withColumn("block", F.pmod(F.xxhash64("rid", "piece"), F.lit(blocks)))
              .groupBy("block")
              .applyInPandas(packed, "doc_id string, piece long, start long, length long, bin long, "
                                     "bin_offset long, bin_capacity int"))
    return id_back(placed, "doc_id", docs, id_col)
