"""A text encoder as a column: fixed-length windows of token ids, a model loaded once a worker, batches of a fixed size.

The model is any function from windows of ids to vectors, made by a loader that runs in the worker. The one here is a
small network of fixed weights, which stands for an encoder trained elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

#: Tokens of a window; ids of tokens, of which 0 fills a window up.
WINDOW, VOCABULARY = 64, 1 << 15
#: Windows in one call of the model.
BATCH = 256


class Network:
    """Token vectors, their mean over the window, one hidden layer and one of output, of length 1. Weights follow from the seed."""

    def __init__(self, width: int = 32, hidden: int = 64, out: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.tokens = r.normal(size=(VOCABULARY, width))
        self.first, self.second = r.normal(size=(width, hidden)) / np.sqrt(width), r.normal(size=(hidden, out)) / np.sqrt(hidden)

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        ids = windows.astype(np.int64)
        real = (ids > 0)[:, :, None]
        mean = (self.tokens[ids] * real).sum(1) / np.maximum(real.sum(1), 1)
        v = np.maximum(mean @ self.first, 0) @ self.second
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def token_ids(text: Column) -> Column:
    """An id from 1 for each word of letters and digits, in small letters, by hash."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: (F.pmod(F.xxhash64(w), F.lit(VOCABULARY - 1)) + 1).cast("int"))


def windows(ids: Column, size: int = WINDOW) -> Column:
    """An array of ids as windows of `size`, the last one filled up with 0; none of no ids."""
    starts = F.when(F.size(ids) > 0, F.sequence(F.lit(1), F.size(ids), F.lit(size))).otherwise(F.array().cast("array<int>"))
    cut = F.transform(starts, lambda i: F.slice(ids, i, size))
    return F.transform(cut, lambda w: F.concat(w, F.array_repeat(F.lit(0), F.lit(size) - F.size(w))))


def encoder(load: Callable[[], Callable[[np.ndarray], np.ndarray]] = Network, size: int = WINDOW, batch: int = BATCH) -> Callable[[Column], Column]:
    """A column function from windows to vectors. load runs once in each worker, and its model sees `batch` windows at once."""
    return predict_batch_udf(load, return_type=ArrayType(DoubleType()), batch_size=batch, input_tensor_shapes=[[size]])


def encoded(df: DataFrame, key: str, text: str, load: Callable[[], Callable[[np.ndarray], np.ndarray]] = Network, size: int = WINDOW, batch: int = BATCH) -> DataFrame:
    """(key, n_windows, vector): the whole text of each row as the mean of its windows' vectors, each by its number of words, of length 1; null without a word. key is unique.

    A long text is many rows, which the model sees in the batches of any others.
    """
    rows = df.select(key, token_ids(F.col(text)).alias("ids"))
    parts = rows.select(key, F.explode(windows(F.col("ids"), size)).alias("window")).withColumn("n", F.size(F.filter("window", lambda i: i > 0)))
    seen = parts.withColumn("v", encoder(load, size, batch)(F.col("window"))).select(key, "n", F.posexplode("v").alias("place", "x"))
    sums = seen.groupBy(key, "place").agg(F.sum(F.col("x") * F.col("n")).alias("x"), F.count("*").alias("n_windows"))
    vector = F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda p: p["x"])
    whole = sums.groupBy(key).agg(vector.alias("v"), F.first("n_windows").alias("n_windows"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = F.get(F.transform(F.array(norm), lambda n: F.transform("v", lambda x: F.try_divide(x, n))), F.lit(0))
    return df.select(key).join(whole.select(key, "n_windows", unit.alias("vector")), key, "left").withColumn("n_windows", F.coalesce("n_windows", F.lit(0)))
