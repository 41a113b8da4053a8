"""Edits that turn recognised texts into true ones, and error rates of whole groups of texts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quillspark.operators.rouge import tokens

EDITS = StructType([StructField(c, LongType()) for c in ("substitutions", "deletions", "insertions")])
#: An edit outweighs any number of substitutions.
EDIT = 1 << 32


def edits(truth: Sequence, found: Sequence) -> tuple[int, int, int]:
    """Substitutions, deletions and insertions of the shortest way from truth to found; of several the one with fewest substitutions.

    One row of the table of costs is kept: a cost holds both numbers, and deletions less insertions are the difference
    of the lengths. So a long text needs no table of all ways, and there is nothing to trace back.
    """
    n, m = len(truth), len(found)
    if not n or not m:
        return 0, n, m
    codes: dict = {}
    a, b = (np.array([codes.setdefault(x, len(codes)) for x in side]) for side in (truth, found))
    slope = EDIT * np.arange(m + 1, dtype=np.int64)
    row = slope.copy()
    for x in a:
        new = row + EDIT  # without this one of truth
        new[1:] = np.minimum(new[1:], row[:-1] + np.where(b == x, 0, EDIT + 1))
        row = np.minimum.accumulate(new - slope) + slope  # with more of found
    total, replaced = divmod(int(row[-1]), EDIT)
    deleted = (total - replaced + n - m) // 2
    return replaced, deleted, total - replaced - deleted


@F.pandas_udf(EDITS)
def _edits(truth: pd.Series, found: pd.Series) -> pd.DataFrame:
    known: dict = {}
    out = []
    for a, b in zip(truth, found, strict=True):
        pair = (tuple(a), tuple(b))
        if pair not in known:
            known[pair] = edits(*pair)
        out.append(known[pair])
    return pd.DataFrame(out, columns=["substitutions", "deletions", "insertions"], dtype="int64")


def characters(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")


def with_edits(df: DataFrame, truth: str, found: str, words: bool = False) -> DataFrame:
    """df with substitutions, deletions, insertions and size, that of the truth, in characters or words. Null texts are empty."""
    unit = tokens if words else characters
    parts = df.withColumns({"true_units": unit(F.col(truth)), "found_units": unit(F.col(found))})
    told = parts.withColumns({"edits": _edits(F.col("true_units"), F.col("found_units")), "size": F.size("true_units").cast("long")})
    return told.select(*df.columns, "edits.*", "size")


def error_rates(df: DataFrame, by: list[str], truth: str, found: str, words: bool = False) -> DataFrame:
    """(by, texts, size, substitutions, deletions, insertions, rate) of each group: all its edits over all its true characters or words.

    Edits are summed in each task before the shuffle, so that a group may be of any size. Without a true unit the rate is null.
    """
    sums = [F.sum(c).alias(c) for c in ("size", "substitutions", "deletions", "insertions")]
    out = with_edits(df, truth, found, words).groupBy(*by).agg(F.count("*").alias("texts"), *sums)
    return out.withColumn("rate", F.try_divide((F.col("substitutions") + F.col("deletions") + F.col("insertions")).cast("double"), F.col("size").cast("double")))
