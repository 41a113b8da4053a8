"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The model is fitted on a bounded sample of labelled rows; its L1 term leaves few weights other than zero, so
the weights travel with the scoring function, and scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import give_back, held_out, mixed, run_hashes, runs, sliced, text_bytes

#: Bytes of words: ASCII letters and digits, and all bytes of longer UTF-8 sequences. Capitals count as small.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
BASE = 0x9E3779B97F4A7C15
#: At most so many labelled rows are learned from; those with the smallest hash of doc_id.
SAMPLE, SAMPLE_BYTES = 8000, 64 << 20
BITS = 20


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) of each word, pair of neighbours, and pair with one or two words between them."""
    low = LOWER[data]
    starts, ends, text = runs(IN_WORD[low], offsets)
    word = run_hashes(low, starts, ends, BASE)
    texts, found = [text], [word]
    for gap in (1, 2, 3):
        if len(word) > gap:
            same = text[gap:] == text[:-gap]
            texts.append(text[gap:][same])
            found.append(mixed(word[:-gap] * np.uint64(0xD6E8FEB86659FD93) + word[gap:] + np.uint64(gap))[same])
    return np.concatenate(texts), (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int32)


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss, on presence features of unit length."""

    def __init__(self, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)  # the last is the bias

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _sample_features(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        offsets, data = text_bytes(batch.column("text"))
        text, found = features(data, offsets, bits)
        own = [np.unique(found[text == i]) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("toxic"), pa.array(own, pa.list_(pa.int32()))], names=["place", "toxic", "features"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = 3, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """Indexes and values of the weights that are not zero, and the bias (None if there was nothing to learn from)."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size"))).alias("one"), F.first("place").alias("place"), F.first("toxic").alias("toxic"))
    upto = F.sum(F.coalesce("one.size", F.lit(0))).over(Window.orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0))  # of sample rows without texts
    few = one.withColumn("upto", upto).where(F.col("upto") <= SAMPLE_BYTES).select(F.col("doc_id").alias("id"), F.col("one.hash").alias("hash"))
    rows = (
        texts.join(F.broadcast(few), (F.col("doc_id") == F.col("id")) & (F.xxhash64("text") == F.col("hash"))).dropDuplicates(["doc_id"]).select("place", "toxic", "text")
        .mapInArrow(lambda b: _sample_features(b, bits), "place bigint, toxic int, features array<int>").toArrow()
    )
    model = Ftrl(bits)
    place, toxic = rows.column("place").to_numpy(), rows.column("toxic").to_numpy()
    lists = rows.column("features").combine_chunks() if rows.num_rows else None
    if lists is None:
        return np.zeros(0, np.int32), np.zeros(0), float("-inf")
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    order = np.lexsort((ends[:-1], place))
    for _ in range(epochs):
        for i in order:
            model.learn(flat[ends[i] : ends[i + 1]], int(toxic[i]))
    w = model.weights()
    at = np.flatnonzero(w[:-1])
    del rows, lists, flat
    give_back()
    return at.astype(np.int32), w[at], float(w[-1])


def _score(batches: Iterator[pa.RecordBatch], model: tuple[np.ndarray, np.ndarray, float], bits: int) -> Iterator[pa.RecordBatch]:
    at, values, bias = model
    weights = np.zeros(1 << bits)
    weights[at] = values
    heavy = weights != 0
    for batch in sliced(batches):
        offsets, data = text_bytes(batch.column("text"))
        text, found = features(data, offsets, bits)
        own = heavy[found]
        once = np.unique((text[own].astype(np.int64) << bits) | found[own])
        total = np.bincount(once >> bits, weights[once & ((1 << bits) - 1)], batch.num_rows) + bias
        score = np.where(np.isneginf(total), 0.0, 1 / (1 + np.exp(-np.clip(total, -500, 500))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5) of every row of docs, by its whole text.

    Learns only from labelled documents that are not held out, `sample` of them and SAMPLE_BYTES of text at most
    (smallest hash of doc_id first, so the same ones at any partitioning; of rows with one doc_id, the text of smallest hash). A document with labels that differ counts as toxic if one of them says so.
    Null, empty and wordless texts get the score of the bias. Without any usable label every score is 0. A null
    doc_id is not held out. Repeated rows are scored one by one; other columns of either table are not read.
    """
    model = fit(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        lambda b: _score(b, model, BITS), "doc_id bigint, held_out boolean, score double, predicted int"
    )
