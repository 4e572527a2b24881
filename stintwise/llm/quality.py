"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates.

A document becomes the relative frequencies of hashed n-grams (n = 1, 2) of its words and marks and of their
shapes (case, digits, punctuation, repetition of the last word). Training reads a sample of labelled rows of at
most ``sample`` documents, deals it over shards of about ``shard_rows``, runs FTRL over each
shard's rows in a fixed order and averages the weights. A score is a sparse dot product: the mean of the weights at the document's n-grams.
"""

from __future__ import annotations

import math
import re
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, small_batches, staged, texts_of

TOKEN = re.compile(r"\w+|[^\w\s]+")
BITS = 18
GAIN = 16.0


class Vocabulary(dict):
    """Token to code, filled as tokens come; the hash and the shape of each code are in arrays. Emptied when full."""

    def __init__(self, most: int = 400_000):
        self.most = most
        self.hashes, self.shapes = [], []

    def __missing__(self, token: str) -> int:
        code = self[token] = len(self.hashes)
        self.hashes.append(crc32(token.encode()))
        self.shapes.append(shape(token))
        return code

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self) > self.most:
            self.clear()
            self.hashes, self.shapes = [], []
        tokens = [TOKEN.findall(t) for t in texts]
        n = np.fromiter(map(len, tokens), np.int64, len(tokens))
        codes = np.fromiter((c for doc in tokens for c in map(self.__getitem__, doc)), np.int64, int(n.sum()))
        return n, np.array(self.hashes, np.uint64)[codes], np.array(self.shapes, np.uint64)[codes]


def shape(token: str) -> int:
    """A small number for the outer form: kind of characters and rough length."""
    kind = 0 if token.islower() else 1 if token.istitle() else 2 if token.isupper() else 3 if token.isdigit() else 4 if token.isalnum() else 5 + crc32(token[:1].encode()) % 32
    return kind * 8 + min(7, len(token) // 2)


def ngrams(vocabulary: Vocabulary, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of n-grams of each text and their buckets end to end; the first of a text is the constant term."""
    n, word, form = vocabulary.coded(texts)
    at = np.cumsum(n) - n
    mix = np.uint64(0x9E3779B97F4A7C15)
    first = np.zeros(len(word), bool)
    first[at[n > 0]] = True
    back = np.roll(word, 1)
    back[first] = 0
    again = word == back
    form = np.where(again, np.uint64(511), form)
    before, last_form = np.where(again, np.uint64(7), back), np.roll(form, 1)
    last_form[first] = 510
    kinds = [(word, 1), (word + before * mix, 2), (form + np.uint64(1 << 40), 3), (form * np.uint64(512) + last_form + np.uint64(1 << 41), 4)]
    out = np.zeros((len(word), len(kinds)), np.int32)
    for i, (value, salt) in enumerate(kinds):
        out[:, i] = 1 + (((value + np.uint64(salt)) * mix) >> np.uint64(64 - BITS)).astype(np.int64) % ((1 << BITS) - 1)
    return n * len(kinds), out.reshape(-1)


def example(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets with their relative frequency; bucket 0 is the constant term."""
    index, count = np.unique(buckets, return_counts=True)
    return np.r_[0, index].astype(np.int32), np.r_[1.0, GAIN * count / max(1, len(buckets))].astype(np.float32)


def ftrl(examples: list, alpha: float, beta: float, l1: float, l2: float, epochs: int) -> np.ndarray:
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(i: np.ndarray) -> np.ndarray:
        held = z[i]
        return np.where(np.abs(held) <= l1, 0.0, (np.sign(held) * l1 - held) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for i, x, y in examples:
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    return weights(np.arange(1 << BITS))


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000, shard_rows: int = 4096, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, epochs: int = 4) -> np.ndarray:
    """Weights of the model. Learns from rows outside the held-out fold only, ``sample`` of them at most.

    Several labels of a document count as their mean; null labels do not count. Without labels all weights are 0.
    """
    one = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = one.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = staged(chosen, "quality-sample")
    shards = max(1, math.ceil(chosen.count() / shard_rows))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of 16 bytes

    def read(batches):
        vocabulary = Vocabulary()
        for batch in small_batches(batches, "text"):
            n, buckets = ngrams(vocabulary, texts_of(batch))
            parts = [example(b) for b in np.split(buckets, np.cumsum(n)[:-1])]
            arrays = [batch.column("doc_id"), batch.column("y"), pa.array([i.tobytes() for i, _ in parts], pa.binary()), pa.array([x.tobytes() for _, x in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "y", "i", "x"])

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["place", "doc_id"])
        examples = [(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32), y) for i, x, y in zip(part["i"], part["x"], part["y"])]
        return pd.DataFrame({"rows": [len(part)], "w": [ftrl(examples, alpha, beta, l1, l2, epochs).astype(np.float32).tobytes()]})

    read_rows = rows.mapInArrow(read, "doc_id long, y double, i binary, x binary")
    dealt = read_rows.withColumns({"place": F.xxhash64("doc_id"), "shard": F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards))})
    fitted = dealt.groupBy("shard").applyInPandas(learn, "rows long, w binary").collect()  # one vector of 2**BITS floats a shard
    if not fitted:
        return np.zeros(1 << BITS)
    vectors = sorted((r["rows"], bytes(r["w"])) for r in fitted)
    return np.average([np.frombuffer(w, np.float32).astype(np.float64) for _, w in vectors], axis=0, weights=[n for n, _ in vectors])


def score_quality(docs: DataFrame, weights: np.ndarray, score: str = "score") -> DataFrame:
    """The columns of ``docs`` with ``score`` (0 to 1) added; null and empty texts get the constant term's score.

    ``docs`` must not have a column of that name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches):
        vocabulary, w = Vocabulary(), shared.value
        for batch in small_batches(batches, "text"):
            n, buckets = ngrams(vocabulary, texts_of(batch))
            sums = np.add.reduceat(np.r_[w[buckets].astype(np.float64), 0.0], np.cumsum(n) - n) if len(n) else np.zeros(0)
            z = float(w[0]) + np.where(n > 0, GAIN * sums / np.maximum(n, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], [*batch.schema.names, score])

    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, **training) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; see ``train_quality`` and ``score_quality``."""
    weights = train_quality(docs, labels, **training)
    scored = score_quality(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), weights)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
