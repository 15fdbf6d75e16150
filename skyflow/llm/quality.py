"""Quality classifier on supervised subword embeddings.

A word is the mean of the learned vectors of its own hash and of its 3- and 4-grams' (of its bytes) hashes, a text the
mean of its words; a softmax layer on the text's vector gives the class. Vectors and layer are learned by
stochastic gradient descent in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflow.llm.common import ENTRY_BYTES, KEPT_BYTES, LONGEST_KEY, begin, map_rows, numbered, prepare, written

#: Hash places of words and n-grams, and length of their vectors.
BUCKETS, WIDTH = 1 << 17, 8
#: Labelled rows that the fit uses, about; chosen by hash of the id when there are more.
FIT_ROWS = 3000
#: Hash places of all rows of the fit together, at most; bounds the bytes that come to the driver (8 a place).
FIT_PLACES = 1 << 25


def places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash places of words and of their n-grams of 3 and 4 bytes (with an end mark on both sides), word by word,
    and how many each word has."""
    marked = [b"<" + w.encode() + b">" for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked) + bytes(4), np.uint8).astype(np.uint64)
    ends, own = np.cumsum(size), np.repeat(np.arange(len(words)), size)
    at = np.arange(len(own))
    code = data[:-4] | data[1:-3] << np.uint64(8) | data[2:-2] << np.uint64(16)
    found, of = [np.fromiter((zlib.crc32(w) % BUCKETS for w in marked), np.int64, len(marked))], [np.arange(len(words))]
    for n in (3, 4):
        if n == 4:
            code = code | data[3:-1] << np.uint64(24)
        inside = at + n <= ends[own]
        found.append(((code[inside] * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(40)).astype(np.int64) % BUCKETS)
        of.append(own[inside])
    of_all = np.concatenate(of)
    order = np.argsort(of_all, kind="stable")
    return np.concatenate(found)[order], np.bincount(of_all, minlength=len(words))


def text_features(text: str | None) -> tuple[list[int], list[float]]:
    """Hash places of a text and their weights, which sum to 1 (none for an empty text)."""
    words = (text or "").split()
    if not words:
        return [], []
    counts = Counter(words)
    found, n = places(list(counts))
    weight = np.fromiter(counts.values(), float, len(counts)) / len(words) / n
    place, back = np.unique(found, return_inverse=True)
    return place.tolist(), np.bincount(back, np.repeat(weight, n)).tolist()


class SubwordModel:
    """Two-class model; ``place_score`` is each hash place's share of the log odds, ``bias`` those of no words."""

    def __init__(self, place_score: np.ndarray, bias: float):
        self.place_score, self.bias = place_score.astype(np.float32), float(bias)

    @staticmethod
    def train(rows: list[tuple[list[int], list[float], int]], epochs: int = 12, batch: int = 32, rate: float = 0.3, seed: int = 1) -> SubwordModel:
        """Adaptive-rate SGD on cross entropy. No rows: even odds; one class only: smoothed share of that class."""
        ones = sum(y for *_, y in rows)
        prior = np.log((ones + 1) / (len(rows) - ones + 1))
        if not 0 < ones < len(rows):
            return SubwordModel(np.zeros(BUCKETS), prior)
        rng = np.random.default_rng(seed)
        vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
        layer, bias = np.zeros((WIDTH, 2), np.float32), np.array([0, prior], np.float32)
        sums = [np.full(x.shape, 1e-6, np.float32) for x in (vectors[:, 0], layer, bias)]
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for lo in range(0, len(rows), batch):
                part = [rows[i] for i in order[lo : lo + batch]]
                places = np.concatenate([np.asarray(p, np.int64) for p, _, _ in part])
                weight = np.concatenate([np.asarray(w, np.float32) for _, w, _ in part])
                of = np.repeat(np.arange(len(part)), [len(p) for p, _, _ in part])
                scaled = vectors[places] * weight[:, None]
                hidden = np.stack([np.bincount(of, scaled[:, k], len(part)) for k in range(WIDTH)], 1).astype(np.float32)
                logits = hidden @ layer + bias
                soft = np.exp(logits - logits.max(1, keepdims=True))
                soft /= soft.sum(1, keepdims=True)
                soft[np.arange(len(part)), [y for *_, y in part]] -= 1
                g_layer, g_bias, g_hidden = hidden.T @ soft / len(part), soft.mean(0), soft @ layer.T
                touched, back = np.unique(places, return_inverse=True)
                g_rows = np.stack([np.bincount(back, weight * g_hidden[of, k], len(touched)) for k in range(WIDTH)], 1).astype(np.float32)
                sums[0][touched] += (g_rows**2).mean(1)
                vectors[touched] -= rate * g_rows / np.sqrt(sums[0][touched])[:, None]
                for value, g, s in ((layer, g_layer, sums[1]), (bias, g_bias, sums[2])):
                    s += g**2
                    value -= rate * g / np.sqrt(s)
        return SubwordModel(vectors @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0])

    def word_scores(self, words: list[str]) -> list[float]:
        """A word's share of the log odds."""
        found, n = places(words)
        return (np.bincount(np.repeat(np.arange(len(n)), n), self.place_score[found], len(n)) / n).tolist()

    def scores(self, texts: list[str | None], known: dict[str, float]) -> list[float]:
        """Probabilities of class 1; ``known`` keeps words within ``KEPT_BYTES``, long ones not at all."""
        split = [(t or "").split() for t in texts]
        if len(known) * (ENTRY_BYTES + LONGEST_KEY // 4) > KEPT_BYTES:
            known.clear()
        new = list({w for words in split for w in words if w not in known})
        if new:
            known.update(zip(new, self.word_scores(new)))
        get = known.__getitem__
        odds = np.array([self.bias + (sum(map(get, w)) / len(w) if w else 0.0) for w in split])
        for w in new:
            if len(w) > LONGEST_KEY:
                del known[w]
        return (1 / (1 + np.exp(-np.clip(odds, -500, 500)))).tolist()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS, places: int = FIT_PLACES) -> SubwordModel:
    """Learns from the labelled rows of ``docs``, about ``rows`` of them chosen by hash of the id.

    Null ids and labels other than 0 and 1 are left out, and so are ids with both labels. The sample's size does not
    depend on the data's: where its texts have more than ``places`` hash places, ids with the largest hashes go.
    """
    prepare(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other")).where("label = other").drop("other")
    share = rows / max(1, known.count())
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    known = known.withColumn("order", order).where(F.col("order") < int(share * (1 << 30)))
    # about `rows` ids are sent
    picked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(F.col("doc_id").cast("string"), "order", "text", "label")

    def extract(items: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, order, text, y in items:
            yield doc_id, order, *text_features(text), y

    got = written(map_rows(picked, extract, "doc_id string, order long, places array<int>, weights array<float>, label int", 100), "features")
    sizes = got.groupBy("order").agg(F.sum(F.size("places") + F.lit(100)).alias("n")).orderBy("order").collect()  # one a picked id
    fits = np.cumsum([r["n"] for r in sizes]) <= places
    last = sizes[int(fits.sum()) - 1]["order"] if fits.any() else -1
    got = got.where(F.col("order") <= last).orderBy("doc_id").toArrow()
    place, weight = got.column("places").combine_chunks(), got.column("weights").combine_chunks()
    ends, place, weight = np.asarray(place.offsets), place.values.to_numpy(), weight.values.to_numpy()
    return SubwordModel.train([(place[a:b], weight[a:b], y) for a, b, y in zip(ends, ends[1:], got.column("label").to_pylist())])


def scored(text: Column, model: SubwordModel, spark) -> Column:
    """Score of a text column, 0 to 1; null and empty texts get the share of class 1."""
    # BUCKETS numbers, as plain values: a broadcast is pickled by reference, and workers need not have this package
    sent = spark.sparkContext.broadcast((model.place_score, model.bias))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        begin()
        m, known = SubwordModel(*sent.value), {}
        for texts in batches:
            texts = texts.tolist()
            parts = [m.scores(texts[lo : lo + 250], known) for lo in range(0, len(texts), 250)]
            yield pd.Series([x for part in parts for x in part], dtype="float64")

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (replaced if there), learned on ``train_docs`` or ``docs``."""
    model = fit(train_docs if train_docs is not None else docs, labels)
    docs = docs.drop("score")
    plain = numbered(docs)
    text = F.col(plain.columns[docs.columns.index("text")])
    return plain.withColumn("score", scored(text, model, docs.sparkSession)).toDF(*docs.columns, "score")
