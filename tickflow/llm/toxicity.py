"""Toxicity by a classifier chain.

The categories are predicted one after another by logistic models over the
presence of word and word-beginning features.  Each later model also gets the
probabilities of the earlier categories.  While fitting, those probabilities
come from models that have not seen the row (k folds), so a later model meets
inputs as good, or as bad, as it will meet when scoring.

Fitting uses a bounded, deterministic sample of the labelled documents
(``per_class`` rows of either toxicity label); its features are made in
parallel and the models fitted in one task over that bounded sample.  Scoring
is a narrow ``mapInPandas`` over whole texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import id_back, id_text, stored

FOLDS = 4
PER_CLASS = 3_000
MAX_FEATURES = 4_096
MIN_DOCS = 3
# Features whose document counts depart from chance by so many standard deviations are used.
MIN_STRENGTH = 3.5
BUCKETS = 1 << 22
STEPS = 120
L2 = 0.02
# A toxic document is "dense" when a distinct word in so many carries a toxic feature.
DENSE_ONE_IN = 25
CATEGORIES = ("toxic", "dense_toxic", "low_quality")
# Words a worker remembers, none longer than MEMO_LENGTH (longer ones are hashed whole each time).
MEMO_WORDS, MEMO_LENGTH = 300_000, 100
THRESHOLD = 0.35

find_words = re.compile(r"[^\W\d_]+").findall


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: the word and its beginnings."""
    parts = [f"={word}"] + [f"^{word[:n]}" for n in (4, 5, 6) if len(word) >= n]
    return tuple(zlib.crc32(p.encode("utf-8")) % BUCKETS for p in parts)


def features(text: str) -> np.ndarray:
    found: set[int] = set()
    for w in set(find_words(text.lower())):
        found.update(word_features(w))
    return np.sort(np.fromiter(found, dtype=np.int32, count=len(found)))


def logistic(rows: np.ndarray, cols: np.ndarray, extra: np.ndarray, y: np.ndarray, width: int):
    """Weights of a logistic model with L2 penalty: sparse presence features
    (``rows``, ``cols``), dense ``extra`` columns, and an intercept, by
    accelerated gradient steps."""
    n = len(y)
    w, v, b = np.zeros(width), np.zeros(extra.shape[1]), 0.0
    w0, v0, b0 = w, v, b
    if not n or y.min() == y.max():
        return w, v, (-20.0 if not n or not y.max() else 20.0)
    active = np.bincount(rows, minlength=n).max() + 1 + extra.shape[1]
    step = 4.0 / active
    for t in range(STEPS):
        z = np.bincount(rows, weights=w[cols], minlength=n) + extra @ v + b
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        gw = np.bincount(cols, weights=r[rows], minlength=width) + L2 / n * w
        # every feature moves at its own scale: rare ones would hardly move otherwise
        share = np.bincount(cols, minlength=width) / n + 1e-3
        nw, nv, nb = w - step * gw / np.sqrt(share) * 4, v - step * 4 * (extra.T @ r), b - step * r.sum() * 4
        m = t / (t + 3)
        w, v, b = nw + m * (nw - w0), nv + m * (nv - v0), nb + m * (nb - b0)
        w0, v0, b0 = nw, nv, nb
    return w0, v0, float(b0)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_models(feats: list[np.ndarray], labels: np.ndarray, fold: np.ndarray) -> pd.DataFrame:
    """Chain over one bounded sample.  ``labels``: toxic and low_quality, one
    row per document.  Returns (category, kind, feature, weight) rows, kind
    ``word``, ``chain`` (feature: position of the earlier category) or
    ``bias``."""
    n = len(feats)
    sizes = np.array([len(f) for f in feats], dtype=np.int64)
    rows = np.repeat(np.arange(n), sizes)
    cols = np.concatenate(feats) if n else np.zeros(0, dtype=np.int32)
    names, cols = np.unique(cols, return_inverse=True)
    out = []
    if not n:
        return pd.DataFrame(out, columns=["category", "kind", "feature", "weight"])

    def strength(y):
        """How far each feature's document counts depart from the label's share."""
        seen = np.bincount(cols, minlength=len(names))
        with_y = np.bincount(cols, weights=y[rows], minlength=len(names))
        p = (y.sum() + 0.5) / (n + 1)
        z = (with_y - seen * p) / np.sqrt(seen * p * (1 - p) + 1e-9)
        return np.where(seen >= MIN_DOCS, z, 0.0)

    toxic, low = labels[:, 0].astype(float), labels[:, 1].astype(float)
    strong = strength(toxic) > 6
    hits = np.bincount(rows, weights=strong[cols], minlength=n)
    dense = toxic * (hits * DENSE_ONE_IN >= sizes / 2.5)
    earlier = np.zeros((n, 0))
    for k, (name, y) in enumerate(zip(CATEGORIES, (toxic, dense, low))):
        z = np.abs(strength(y))
        kept = np.sort(np.argsort(-z, kind="stable")[:MAX_FEATURES])
        kept = kept[z[kept] > MIN_STRENGTH]
        place = np.full(len(names), -1)
        place[kept] = np.arange(len(kept))
        use = place[cols] >= 0
        r, c = rows[use], place[cols[use]]
        unseen = np.zeros(n)
        for f in range(FOLDS):
            inside = fold != f
            number = np.cumsum(inside) - 1
            at = inside[r]
            w, v, b = logistic(number[r[at]], c[at], earlier[inside], y[inside], len(kept))
            zf = np.bincount(r, weights=w[c], minlength=n) + earlier @ v + b
            unseen[~inside] = sigmoid(zf)[~inside]
        w, v, b = logistic(r, c, earlier, y, len(kept))
        out += [(k, "word", int(names[j]), float(x)) for j, x in zip(kept, w) if x]
        out += [(k, "chain", i, float(x)) for i, x in enumerate(v)] + [(k, "bias", 0, b)]
        earlier = np.column_stack([earlier, unseen])
    return pd.DataFrame(out, columns=["category", "kind", "feature", "weight"])


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str, text_col: str) -> DataFrame:
    """Labelled documents, one row per id and text, at most ``per_class`` of
    either toxicity label: those with the smallest hash of id and text, so every
    run takes the same ones.  Only labels of texts that are there are counted."""
    lab = (labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1))
           .select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"),
                   F.coalesce(F.col("quality").cast("int"), F.lit(1)).alias("quality")).distinct())
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).where("text is not null")
    texts = texts.withColumn("t", F.md5("text"))
    # ids and hashes only; repeats are gone before the join
    lab = texts.select("id", "t").distinct().join(lab, "id").withColumn("h", F.xxhash64("id", "t"))
    parts = [lab.where(F.col("toxic") == t).orderBy("h", "id", "t", "quality").limit(per_class) for t in (0, 1)]
    chosen = stored(parts[0].unionByName(parts[1]), "training-sample")  # 2 * per_class rows at most
    once = (texts.join(F.broadcast(chosen.select("id", "t").distinct()), ["id", "t"])
            .groupBy("id", "t").agg(F.min("text").alias("text")))
    return once.join(F.broadcast(chosen), ["id", "t"]).drop("t")


def fit_chain(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
              id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, str, int, float]]:
    """Fits the chain; returns its weights (bounded by categories times
    MAX_FEATURES).  Labels that are null or not 0/1, and labels of absent or
    null texts, take no part; without labelled rows the chain is empty."""
    sample = training_sample(docs, labels, per_class, id_col, text_col)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"one": 0, "h": b["h"], "id": b["id"], "toxic": b["toxic"], "quality": b["quality"],
                                "fold": [zlib.crc32(t.encode("utf-8")) % FOLDS for t in b["text"]],
                                "feats": [features(t) for t in b["text"]]})

    kind = sample.schema["id"].dataType.simpleString()
    feats = sample.mapInPandas(
        made, f"one int, h long, id {kind}, toxic int, quality int, fold int, feats array<int>")

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["h", "id", "toxic", "quality"], kind="stable")
        labels_of = np.column_stack([group["toxic"].to_numpy(), 1 - group["quality"].to_numpy()])
        return fit_models([np.asarray(f, dtype=np.int32) for f in group["feats"]], labels_of, group["fold"].to_numpy())

    # one group on purpose: the sample is bounded by 2 * per_class rows
    model = feats.groupBy("one").applyInPandas(fitted, "category int, kind string, feature int, weight double")
    return [tuple(r) for r in model.collect()]


class Chain:
    """The fitted chain on a worker: sums the weights of a text's features."""

    def __init__(self, model: list[tuple[int, str, int, float]]):
        n = len(CATEGORIES)
        self.bias = [-20.0] * n
        self.links = [[0.0] * n for _ in range(n)]
        self.weight: dict[int, list[float]] = {}
        for k, kind, feature, w in model:
            if kind == "bias":
                self.bias[k] = w
            elif kind == "chain":
                self.links[k][feature] = w
            else:
                self.weight.setdefault(feature, [0.0] * n)[k] = w
        self.memo: dict[str, tuple[int, ...]] = {}

    def score(self, text: str) -> list[float]:
        """Probability of every category, each later one given the earlier."""
        hit: set[int] = set()
        memo, weight = self.memo, self.weight
        for w in set(find_words(text.lower())):
            got = memo.get(w)
            if got is None:
                got = tuple(f for f in word_features(w) if f in weight)
                if len(w) <= MEMO_LENGTH:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[w] = got
            if got:
                hit.update(got)
        total = list(self.bias)
        for f in sorted(hit):
            total = [a + b for a, b in zip(total, weight[f])]
        out: list[float] = []
        for k, z in enumerate(total):
            z += sum(p * self.links[k][i] for i, p in enumerate(out))
            out.append(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))
        return out


def rejects(text: str, p, threshold: float) -> bool:
    """The verdict on a text by its probabilities, unrounded: the query and the
    filtering stage share it."""
    return bool(text) and max(p[:2]) >= threshold


def score_chain(docs: DataFrame, model: list[tuple[int, str, int, float]], threshold: float = THRESHOLD,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, one ``p_<category>`` per category (shown to 6
    places), and ``rejected`` (a toxicity category at or above ``threshold``).

    A null or empty text has no features: it scores the intercepts alone and is
    never rejected.  With an empty model nothing is rejected.  A null id stays
    null; repeated rows give repeated results; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: categories * MAX_FEATURES

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chain = Chain(shared.value)
        for b in batches:
            texts = b.iloc[:, 1].fillna("")
            p = np.array([chain.score(t) for t in texts]).reshape(len(texts), len(CATEGORIES))
            bad = [rejects(t, row, threshold) for t, row in zip(texts, p)]
            yield pd.DataFrame({"id": b.iloc[:, 0], **{f"p_{c}": p[:, k].round(6) for k, c in enumerate(CATEGORIES)},
                                "rejected": np.array(bad, dtype=bool)})

    cols = ", ".join(f"p_{c} double" for c in CATEGORIES)
    scored = (docs.select(id_text(docs, id_col), docs[text_col].cast("string"))
              .mapInPandas(rows, f"id string, {cols}, rejected boolean"))
    return id_back(scored, "id", docs, id_col)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fits the chain on the labelled documents and scores every document."""
    return score_chain(docs, fit_chain(docs, labels, per_class, id_col, text_col), threshold, id_col, text_col)


def without_toxic(docs: DataFrame, model: list[tuple[int, str, int, float]], threshold: float = THRESHOLD,
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the chain does not
    reject.  Null and empty texts stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: categories * MAX_FEATURES
    place = docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(shared.value)
        for b in batches:  # as Arrow batches, so that the other columns pass through unchanged
            kept = [not t or not rejects(t, chain.score(t), threshold) for t in b.column(place).to_pylist()]
            yield b.filter(pa.array(kept, type=pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
