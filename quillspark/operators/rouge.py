"""Overlap of predicted with true texts: n-grams as multisets, and the longest common subsequence of words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quillspark.functions.similarity import lcs_length

SIZES = (1, 2)


def tokens(text: Column) -> Column:
    """Runs of letters and digits, in small letters; none of a null text. Words are not stemmed."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def common_grams(n: int) -> Callable[[Column, Column], Column]:
    """A column function of two arrays of words: how many runs of n words they share, each as often as both have it."""

    @F.pandas_udf(LongType())
    def shared(a: pd.Series, b: pd.Series) -> pd.Series:
        counts = lambda words: Counter(zip(*[words[i:] for i in range(n)], strict=False))
        return pd.Series([(counts(x) & counts(y)).total() for x, y in zip(a, b, strict=True)], dtype="int64")

    return shared


def _measured(hits: Column, predicted: Column, truth: Column) -> list[Column]:
    """Precision, recall and their harmonic mean; 0 where nothing is predicted or true."""
    p, r = (F.coalesce(F.try_divide(hits.cast("double"), n.cast("double")), F.lit(0.0)) for n in (predicted, truth))
    return [p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1")]


def rouge_n(df: DataFrame, keys: list[str], predicted: str, truth: str, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """(keys, n, precision, recall, f1) of every row and size. keys are unique; a gram counts as often as both sides have it.

    Both sides of a row are in it, so grams are counted there and never shuffled; rows without a gram have zeros.
    """
    words = df.select(*keys, tokens(F.col(predicted)).alias("p"), tokens(F.col(truth)).alias("t"))
    counted = words.select(*keys, *[common_grams(n)(F.col("p"), F.col("t")).alias(f"hits_{n}") for n in sizes], F.size("p").alias("p"), F.size("t").alias("t"))
    places = lambda c, n: F.greatest(F.col(c) - (n - 1), F.lit(0)).alias(c)
    each = counted.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"hits_{n}").alias("hits"), places("p", n), places("t", n)) for n in sizes])).alias("g"))
    return each.select(*keys, "g.n", *_measured(F.col("g.hits"), F.col("g.p"), F.col("g.t")))


@F.pandas_udf(LongType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


def common_words(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two arrays of words."""
    return _shared(a, b)


def rouge_l(df: DataFrame, keys: list[str], predicted: str, truth: str) -> DataFrame:
    """(keys, precision, recall, f1) by the longest common subsequence of words of each row."""
    words = df.select(*keys, tokens(F.col(predicted)).alias("p"), tokens(F.col(truth)).alias("t")).withColumn("hits", common_words(F.col("p"), F.col("t")))
    return words.select(*keys, *_measured(F.col("hits"), F.size("p"), F.size("t")))


def means(df: DataFrame, keys: list[str], predicted: str, truth: str, digits: int = 4) -> DataFrame:
    """(measure, precision, recall, f1): means over all rows of rouge1, rouge2 and rougeL."""
    by_n = rouge_n(df, keys, predicted, truth).select(F.concat(F.lit("rouge"), F.col("n").cast("string")).alias("measure"), "precision", "recall", "f1")
    by_l = rouge_l(df, keys, predicted, truth).select(F.lit("rougeL").alias("measure"), "precision", "recall", "f1")
    return by_n.unionByName(by_l).groupBy("measure").agg(*[F.round(F.avg(c), digits).alias(c) for c in ("precision", "recall", "f1")])
