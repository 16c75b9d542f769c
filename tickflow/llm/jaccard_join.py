"""N-gram Jaccard join by PartEnum signatures.

A text's set holds its distinct word shingles, as 64-bit hashes.  Equal sets
form a class, so copies cost one set.  Two sets of similarity ``T`` percent or
more differ in at most ``k`` elements, where ``k`` follows from their sizes.

PartEnum: set sizes are cut into bands so that similar sets lie in the same or
in neighbouring bands; instance j serves bands j-1 and j.  The shingle domain
is hashed into ``n1 * n2`` cells, ``n1`` groups of ``n2``; with
``n1 * (k2 + 1) > k`` at least one group holds no more than ``k2`` of the
differences, so at least one choice of ``n2 - k2`` of its cells is equal in both sets.
The signature of a choice hashes the elements in its cells, and all choices
of all groups are enumerated.

An empty choice says nothing, and would be shared by many sets.  So there are
``spare`` more groups than needed: a set with at most ``spare`` groups in
which some choice is empty meets every similar set on a choice that is not
empty.  The few other sets (mostly tiny) also carry the shingles of their
prefix, by hash order: two of them that are similar share one of those.

Sets that share a signature are candidates.  In a few star rounds each set is
compared with leaders of its signatures, and what is joined is not compared
again; all pairs left between different components are then compared, so no
link that matters to a component is lost, and copies or dense groups do not
multiply into all their pairs.  A parity sketch of each set bounds the
difference from below and turns most false candidates away, those of the last
step inside its join; the rest are compared exactly on the texts' shingles.

Pages of one template agree on the cells that the template fills, without
being similar.  A signature that is still held by more than ``HOT_ROWS``
classes of different components is therefore refined: its classes order their
shingles by how often all such classes hold them and meet on the prefix of the
rarest ones.  Similar sets share a shingle of their prefixes whatever the
order, so nothing is lost; and what a template brings comes last in it.
"""

from __future__ import annotations

import itertools
import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.llm.common import dropped, id_back, id_text, small_side, stored
from tickflow.llm.components import components

# Digests a task remembers, so that a copy seen again emits no signatures.
SEEN_DIGESTS = 100_000
# Rows handed back at a time by the shingling tasks.
PORTION = 500
# Star rounds, and the leaders a set is compared with in each.
STAR_ROUNDS, LEADERS = 3, 8
# Places of the short sketch that travels with the signatures of the last step.
SHORT_BITS = 512
SHORT = [f"k{i}" for i in range(SHORT_BITS // 64)]
# Classes of one signature whose pairs are compared at once; a signature with
# more is refined by prefixes (which reads and shuffles its texts again, so it
# does not pay for small groups), and a larger group is cut into cells of that size.
HOT_ROWS = 1_024
# Counters by which the shingles of refined classes are ordered (8 bytes each, broadcast).
COUNTERS = 1 << 18
# Largest difference for which three cells a group are used (two beyond it).
FINE_UP_TO = 40

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S32)) * _M2
        x = (x ^ (x >> _S32)) * _M2
        return x ^ (x >> _S32)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a text: A-Z lower
    cased, words split at ASCII white space; fewer words make one shingle."""
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    size = min(n, len(w))
    with np.errstate(over="ignore"):
        acc = np.full(len(w) - size + 1, size, dtype=np.uint64)
        for j in range(size):
            acc = (acc ^ (acc >> _S32)) * _M1 + w[j:len(w) - size + 1 + j]
    return np.unique(mixed(acc))


class Bands:
    """Size bands and the PartEnum parameters of each instance."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]

    def of(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def differences(self, j: int) -> int:
        """Largest symmetric difference of similar sets served by instance j."""
        while len(self.low) <= j + 1:
            self.of(self.low[-1])
        most = self.low[j + 1] - 1
        return 2 * most * (100 - self.percent) // (100 + self.percent)

    def plan(self, j: int) -> tuple[int, int, int, int]:
        """(n1, n2, k2, spare) of instance j."""
        k = self.differences(j)
        n2, k2 = (3, 1) if k <= FINE_UP_TO else (2, 1)
        need = k // (k2 + 1) + 1
        spare = 1 + need // 16
        return need + spare, n2, k2, spare


# Bits of a signature that are shuffled: two that agree by chance only make a
# pair that the comparison turns away.
SIG_BITS = np.uint64((1 << 48) - 2)


def tagged(sig: np.ndarray, instance: int) -> np.ndarray:
    return (sig & SIG_BITS) | np.uint64(instance & 1)


def signatures(s: np.ndarray, bands: Bands) -> np.ndarray:
    """All signatures of one set, as signed 64-bit values; the last bit is the
    parity of the instance.  Sets of one band meet in both of their instances,
    and the first of them, whose parity is the band's, is enough."""
    out = []
    own = bands.of(len(s))
    for j in (own, own + 1):
        if bands.differences(j) == 0:
            continue  # only equal sets are similar: one class already
        n1, n2, k2, spare = bands.plan(j)
        seed = np.uint64(j * 1_000_003 + 17)
        cell = ((s >> _S32) % np.uint64(n1 * n2)).astype(np.int64)
        h = mixed(s ^ mixed(np.array([seed]))[0])
        low = np.bincount(cell, weights=(h & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n1 * n2)
        high = np.bincount(cell, weights=(h >> _S32).astype(np.float64), minlength=n1 * n2)
        count = np.bincount(cell, minlength=n1 * n2).reshape(n1, n2)
        with np.errstate(over="ignore"):
            value = mixed(low.astype(np.uint64) * _M1 + high.astype(np.uint64)).reshape(n1, n2)
            group = mixed(np.arange(n1, dtype=np.uint64) * _M1 + seed)
            weak = np.zeros(n1, dtype=bool)
            for number, choice in enumerate(itertools.combinations(range(n2), n2 - k2)):
                at = list(choice)
                full = count[:, at].sum(axis=1) > 0
                weak |= ~full
                sig = group + np.uint64(number) * _M2
                for c in at:
                    sig = mixed(sig * _M1 + value[:, c] + np.uint64(c))
                out.append(tagged(sig[full], j))
            if weak.sum() > spare:
                # too many empty choices: also the prefix that similar sets share an element of
                prefix = len(s) - -(-bands.percent * len(s) // 100) + 1
                out.append(tagged(mixed(s[:prefix] + seed * _M1 + np.uint64(1)), j))
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.zeros(0, dtype=np.int64)


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the elements in each of 64 * 2^i places, about two a shingle.
    Two sketches differ in no more places than their sets in elements."""
    return parities(s, 64 << max(0, math.ceil(math.log2(max(1, len(s)) / 32))))


def parities(s: np.ndarray, bits: int) -> np.ndarray:
    odd = (np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def digest(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return tuple(int(np.uint64(x).astype(np.int64)) for x in (d >> 64, d & 0xFFFFFFFFFFFFFFFF))


def signature_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(rid, sig) of every row's set, for rows whose numbers are their own
    (``doc_id``); a set this task has already given has none."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            for at in range(0, len(batch), PORTION):
                part = batch.iloc[at:at + PORTION]
                ids, sigs = [], []
                for rid, text in zip(part["doc_id"].tolist(), part["text"]):
                    s = shingle_set(text, n)
                    d = digest(s)
                    if not len(s) or d in seen:
                        continue
                    if len(seen) >= SEEN_DIGESTS:
                        seen.clear()
                    seen.add(d)
                    sigs.append(signatures(s, bands))
                    ids.append(np.full(len(sigs[-1]), rid, dtype=np.int64))
                if ids:
                    yield pd.DataFrame({"rid": np.concatenate(ids), "sig": np.concatenate(sigs)})
    return docs.mapInPandas(rows, "rid long, sig long")


def signed_sets(docs: DataFrame, n: int, percent: int, sign: bool = True) -> DataFrame:
    """(doc_id, n, d1, d2, sigs, sketch, short, band) per row; ``sigs`` and
    what follows are null for a set this task has already given, ``sigs`` for
    all without ``sign``."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            for at in range(0, len(batch), PORTION):
                part = batch.iloc[at:at + PORTION]
                out = []
                for text in part["text"]:
                    s = shingle_set(text, n)
                    d = digest(s)
                    if not len(s) or d in seen:
                        out.append((len(s), *d, None, None, None, None))
                        continue
                    if len(seen) >= SEEN_DIGESTS:
                        seen.clear()
                    seen.add(d)
                    out.append((len(s), *d, signatures(s, bands) if sign else None, parity_sketch(s), parities(s, SHORT_BITS),
                                bands.of(len(s))))
                frame = pd.DataFrame(out, columns=["n", "d1", "d2", "sigs", "sketch", "short", "band"])
                frame["band"] = frame["band"].astype("Int32")
                frame.insert(0, "doc_id", part["doc_id"].reset_index(drop=True))
                yield frame

    signed = docs.withColumn("doc_id", id_text(docs, "doc_id")).mapInPandas(
        rows, "doc_id string, n long, d1 long, d2 long, sigs array<long>, sketch array<long>, short array<long>, "
              "band int")
    return id_back(signed, "doc_id", docs, "doc_id")


def apart(x, y):
    """Places in which two sketches differ, the longer folded to the shorter."""
    def folded(a, b):
        half = F.size(a) / 2
        return F.when(F.size(a) > F.size(b), F.zip_with(
            F.slice(a, F.lit(1), half.cast("int")), F.slice(a, half.cast("int") + 1, half.cast("int")),
            lambda p, q: p.bitwiseXOR(q))).otherwise(a)

    return F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                       F.lit(0), lambda acc, v: acc + v)


def sketched(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their sizes and sketches allow to be similar."""
    a = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(a, "a").join(b, "b")
    total = F.col("na") + F.col("nb")
    near = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) \
        & (apart(F.col("sa"), F.col("sb")) * (100 + percent) <= total * (100 - percent))
    return both.where(near).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets reach the similarity, compared in full."""
    a = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def of(rep, text):
            s = known.get(rep)
            if s is None:
                s = known[rep] = shingle_set(text, n)
                if len(known) > 64:
                    known.popitem(last=False)
            return s

        for batch in batches:
            keep = []
            for x, y, tx, ty in zip(batch["a"], batch["b"], batch["ta"], batch["tb"]):
                sx, sy = of(x, tx), of(y, ty)
                both = len(np.intersect1d(sx, sy, assume_unique=True))
                keep.append(100 * both >= percent * (len(sx) + len(sy) - both))
            yield batch.loc[keep, ["a", "b"]]

    return pairs.join(a, "a").join(b, "b").mapInPandas(rows, "a long, b long")


def rare_prefixes(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(sig, rep) of the texts (rep, text): the rarest shingles of each set, as
    many as similar sets share one of.  Rarity is by counters that shingles
    share by hash; ties, and shingles of one counter, go by the shingle."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount((shingle_set(text, n) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        at = np.nonzero(total)[0]
        yield pd.DataFrame({"at": at, "times": total[at]})

    counts = texts.mapInPandas(counted, "at long, times long").groupBy("at").agg(F.sum("times").alias("times"))
    found = counts.toPandas()  # bounded: COUNTERS rows
    often = np.zeros(COUNTERS, dtype=np.int64)
    often[found["at"].to_numpy(dtype=np.int64)] = found["times"].to_numpy(dtype=np.int64)
    shared = texts.sparkSession.sparkContext.broadcast(often)  # bounded: 8 * COUNTERS bytes

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), PORTION):
                part = batch.iloc[at:at + PORTION]
                sigs = []
                for text in part["text"]:
                    s = shingle_set(text, n)
                    by_rarity = np.lexsort((s, shared.value[(s % np.uint64(COUNTERS)).astype(np.int64)]))
                    sigs.append(s[by_rarity[:len(s) - -(-percent * len(s) // 100) + 1]].view(np.int64))
                yield pd.DataFrame({"sig": np.concatenate(sigs),
                                    "rep": np.repeat(part["rep"].to_numpy(dtype=np.int64), [len(x) for x in sigs])})

    return texts.mapInPandas(rows, "sig long, rep long")


def crowded(held: DataFrame) -> DataFrame:
    """(sig, cells) of the signatures with more than HOT_ROWS rows."""
    return (held.groupBy("sig").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > HOT_ROWS)
            .select("sig", F.ceil(F.col("rows") / HOT_ROWS).cast("int").alias("cells")))


def pairs_apart(x: DataFrame, y: DataFrame, percent: int, once) -> DataFrame:
    """Pairs (a, b) of different components that share a ``sig`` (and a pair
    of cells), of rows (sig, i, j, rep, comp, n, band, short sketch), as far as
    their sizes and short sketches allow them to be similar and ``once``, over
    the aliases x and y, holds."""
    x, y = x.alias("x"), y.alias("y")
    differ = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in SHORT), F.lit(0))
    both = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
                  & ((F.col("x.i") < F.col("x.j")) | (F.col("x.rep") < F.col("y.rep")))
                  & (F.col("x.comp") != F.col("y.comp")) & once
                  & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
                  & (differ * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)))
    return both.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def in_cells(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of :func:`pairs_apart` for groups of any size: a large group
    is cut into cells, and each pair of its cells (i, j) is a group of its own."""
    last = F.coalesce("cells", F.lit(1)) - 1
    own = F.pmod(F.xxhash64("rep"), last + 1).cast("int")
    dealt = held.join(crowded(held), "sig", "left").withColumn("own", own)
    return (dealt.withColumn("i", F.col("own")).withColumn("j", F.explode(F.sequence("own", last))),
            dealt.withColumn("j", F.col("own")).withColumn("i", F.explode(F.sequence(F.lit(0), "own"))))


def texts_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(rep, text) of the classes ``wanted`` (rep, doc_id, d1, d2): the documents
    with their ids are read again, and kept if their set is the class's."""
    ids = wanted.select("doc_id").distinct()
    side = small_side(ids.withColumnRenamed("doc_id", "wanted_id"), ids.count())
    near = docs.join(side, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            d = [digest(shingle_set(t, n)) for t in batch["text"]]
            yield pd.DataFrame({"d1": [x[0] for x in d], "d2": [x[1] for x in d], "text": batch["text"].to_numpy()})

    hashed = near.mapInPandas(rows, "d1 long, d2 long, text string")
    return (hashed.join(wanted.select("rep", "d1", "d2"), ["d1", "d2"])
            .groupBy("rep").agg(F.min("text").alias("text")))


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80,
                       id_col: str = "doc_id", text_col: str = "text", numbered: bool = False) -> DataFrame:
    """One row per input row: id, ``n_shingles`` (size of its set) and
    ``component_id``, the smallest id reachable by links of ``percent``
    Jaccard similarity or more over ``n``-word shingles, itself included.

    A null or empty text, or one without words, has an empty set and is linked
    with nothing: its component is its own id.  Rows are linked by their texts
    alone: repeated rows and rows of one id with several texts each get the
    component of their text; a null id is passed over when the smallest id is
    taken, and stays null in its own row.  Other columns are not read.

    ``numbered`` says that the ids are whole numbers of which each stands in
    one row of a written table: they then stand for the rows, and the signatures
    go to their shuffle as they are made instead of being written first.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    first = signed_sets(docs, n, percent, sign=not numbered)
    first = first.withColumn("rid", F.col("doc_id").cast("long") if numbered else F.monotonically_increasing_id())
    first = stored(first, "signed")  # fixes rid, and keeps the signatures from being made twice
    signed = (signature_rows(docs, n, percent) if numbered else
              first.where("sigs is not null").select("rid", F.explode("sigs").alias("sig")))

    classes = stored(first.where("n > 0").groupBy("d1", "d2")
                     .agg(F.min("rid").alias("rep"), F.min("doc_id").alias("class_id")), "classes")
    rows = stored(first.select("rid", "doc_id", "n", "d1", "d2").join(classes, ["d1", "d2"], "left"), "rows")
    member = rows.where("n > 0").select("rid", "rep")

    # signatures held by two rows or more, then by two classes or more
    of_sig = Window.partitionBy("sig")
    shared = (signed
              .withColumn("lo", F.min("rid").over(of_sig)).withColumn("hi", F.max("rid").over(of_sig))
              .where("lo <> hi").select("sig", "rid"))
    held = stored(shared.join(member, "rid").select("sig", "rep").distinct(), "held")
    sets = (first.where("sketch is not null").select(F.col("rid").alias("rep"), "n", "sketch", "short", "band")
            .join(held.select("rep").distinct(), "rep", "left_semi"))
    sets = stored(sets, "sketches")
    dropped(first)
    involved = rows.where("rid = rep").select("rep", "doc_id", "d1", "d2")

    def checked(pairs: DataFrame) -> DataFrame:
        """The pairs that are similar, from candidate pairs (a, b)."""
        near = stored(sketched(pairs, sets, percent), "near")
        nodes = near.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        texts = stored(texts_of(docs, involved.join(nodes, "rep"), n), "texts")
        similar = stored(confirmed(near, texts, n, percent), "similar")
        dropped(near, texts)
        return similar

    def still_apart(joined: DataFrame | None) -> DataFrame:
        """(sig, rep, comp) of the signatures that hold several components."""
        if joined is None:
            return held.withColumn("comp", F.col("rep"))
        return (held.join(joined, F.col("rep") == F.col("node"), "left")
                .select("sig", "rep", F.coalesce("component", "rep").alias("comp"))
                .withColumn("lo", F.min("comp").over(of_sig)).withColumn("hi", F.max("comp").over(of_sig))
                .where("lo <> hi").select("sig", "rep", "comp"))

    links, joined = None, None
    for turn in range(STAR_ROUNDS):
        # each class against the leaders it shares most signatures with, other leaders every round
        lead = F.min(F.struct(F.xxhash64("rep", F.lit(turn)), "rep", "comp")).over(of_sig)
        led = (still_apart(joined).withColumn("lead", lead).where("lead.comp <> comp")
               .groupBy("rep", F.col("lead.rep").alias("leader")).agg(F.count(F.lit(1)).alias("times")))
        best = Window.partitionBy("rep").orderBy(F.desc("times"), "leader")
        star = (led.withColumn("place", F.row_number().over(best)).where(F.col("place") <= LEADERS)
                .select(F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")).distinct())
        found = checked(star)
        links = found if links is None else stored(links.unionByName(found), "links-so-far")
        joined = components(links)

    # classes of one signature that are still apart: every pair across components
    brief = sets.select("rep", "n", "band", *[F.col("short")[i].alias(c) for i, c in enumerate(SHORT)])
    rest = stored(still_apart(joined), "apart")
    crowds = stored(crowded(rest).select("sig"), "crowds")
    large = small_side(crowds, crowds.count())
    few = rest.join(large, "sig", "left_anti").join(brief, "rep").withColumns({"i": F.lit(0), "j": F.lit(0)})
    # sets of one band share the signatures of both their instances; one is enough
    cross = pairs_apart(few, few, percent, (F.col("x.band") != F.col("y.band"))
                        | (F.col("x.sig").bitwiseAND(1) == F.col("x.band").bitwiseAND(1)))
    many = stored(rest.join(large, "sig", "left_semi").select("rep", "comp").distinct(), "crowd")
    texts = stored(texts_of(docs, involved.join(many, "rep", "left_semi"), n), "crowd-texts")
    # most of the rarest shingles stand in one component only: they go before the sketches are added
    met = (rare_prefixes(texts, n, percent).join(many, "rep")
           .withColumn("lo", F.min("comp").over(of_sig)).withColumn("hi", F.max("comp").over(of_sig))
           .where("lo <> hi").select("sig", "rep", "comp"))
    prefixes = stored(met.join(brief, "rep"), "prefixes")
    refined = pairs_apart(*in_cells(prefixes), percent, F.lit(True))
    more = checked(cross.unionByName(refined).distinct())
    dropped(crowds, many, texts, prefixes)
    final = components(links.unionByName(more))
    dropped(rest, held, sets)

    ids = (rows.where("n > 0").groupBy("rep").agg(F.min("class_id").alias("class_id"))
           .join(final, F.col("rep") == F.col("node"), "left")
           .select("rep", "class_id", F.coalesce("component", "rep").alias("comp")))
    least = ids.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    named = ids.join(least, "comp").select("rep", "component_id")
    return (rows.join(named, "rep", "left")
            .select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text", null_ids_apart: bool = True) -> DataFrame:
    """One row of each component, all columns as they are: the one with the
    smallest id that is not null, and of several with that id the first one
    read.  Rows with an empty set are linked with nothing and all stay.

    Rows are counted, not ids: repeated rows, and near copies whose id also has
    another text, go.  With ``null_ids_apart`` rows without an id are no copies
    of rows that have one: one of them stays in each component, too.
    """
    # written once, so that every step sees the same row numbers
    # (the row is one column, so that no name of the caller's clashes with ours)
    rows = stored(docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*docs.columns).alias("__doc")), "numbered")
    ids = rows.select("__row", F.col(f"__doc.`{id_col}`").alias("__id"))
    texts = rows.select("__row", F.col(f"__doc.`{text_col}`").alias("__text"))
    found = jaccard_components(texts, n, percent, "__row", "__text", numbered=True).where("n_shingles > 0").join(ids, "__row")
    found = stored(found.select("__row", "__id", "component_id"), "row-components")
    no_id = F.col("__id").isNull()
    group = ["component_id", no_id] if null_ids_apart else ["component_id"]
    stays = found.groupBy(*group).agg(F.min(F.struct(no_id.alias("no_id"), "__id", "__row"))["__row"].alias("__row"))
    gone = stored(found.join(stays, "__row", "left_anti").select("__row"), "near-copies")
    return rows.join(small_side(gone, gone.count()), "__row", "left_anti").select("__doc.*")
