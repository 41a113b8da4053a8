"""Whole-frame steps: fills, sizes, sampling, rows side by side, quantiles, status counts, errors kept as data."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.groups import positions, segments_of


def filled(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Null and empty texts of the columns become the given ones."""
    return df.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)) for c, v in values.items()})


def empty_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Empty texts, and those of white space only, become null."""
    return df.withColumns({c: F.when(F.col(c).rlike(r"(?U)\S"), F.col(c)) for c in columns})


def without_nulls(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without a null in the columns; without columns, in any."""
    return df.dropna(subset=list(columns or df.columns))


def rows_of_mapping(df: DataFrame, column: str, value: str) -> DataFrame:
    """(key, fields of value): a JSON object of objects as rows, one an entry; value is the DDL of the inner objects. Entries of null go."""
    entries = df.select(F.explode(F.from_json(column, f"map<string,struct<{value}>>")).alias("key", "fields"))
    return entries.where("fields is not null").select("key", "fields.*")


def lookup(df: DataFrame, on: list[tuple[str, str]], reference: DataFrame, value: str, order: list[Column], into: str) -> DataFrame:
    """df with, as `into`, the value of the first row of the reference, by order, that agrees in the pairs of columns; null without one.

    What a look-up inside a loop over rows does, as one join: the reference is reduced to its first rows before.
    """
    keys = [r for _, r in on]
    first = reference.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias(into)).select(*[F.col(r).alias(f"key_{i}") for i, r in enumerate(keys)], into)
    met = [df[d] == first[f"key_{i}"] for i, (d, _) in enumerate(on)]
    return df.join(first, met, "left").drop(*[f"key_{i}" for i in range(len(on))])


def sized(df: DataFrame, column: str, least: int, most: int) -> DataFrame:
    """Rows whose text has between `least` and `most` characters, both included; null texts go."""
    return df.where(F.length(column).between(least, most))


def sampled(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows without replacement: those of the smallest digests of seed and key, so the same ones at any partitioning."""
    return df.withColumn("draw", F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col(key).cast("string")))).orderBy("draw", key).limit(n).drop("draw")


def side_by_side(a: DataFrame, key_a: str, b: DataFrame, key_b: str) -> DataFrame:
    """Rows of both frames joined by their places in the order of unique numeric keys; the longer one's rest has nulls."""
    return positions(a, key_a).join(positions(b, key_b), "position", "full")


def rows_at(df: DataFrame, key: str, places: list[int]) -> DataFrame:
    """The rows at the places, from 0, in the order of a unique numeric key."""
    return positions(df, key).where(F.col("position").isin(places))


def unique_in_order(df: DataFrame, column: str, order: str) -> DataFrame:
    """(value, first, n): every value with the least order at which it appears, and its count; null is no value."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.min(order).alias("first"), F.count("*").alias("n"))


def distinct_lists(df: DataFrame, column: str, longer_than: int | None = None) -> DataFrame:
    """(list, size, n) of equal lists, in which order counts; if wanted, of those with more than so many values."""
    lists = df.groupBy(F.col(column).alias("list")).agg(F.count("*").alias("n")).withColumn("size", F.size("list"))
    return lists if longer_than is None else lists.where(F.col("size") > longer_than)


def quantiles(df: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """(share, value): exact quantiles with linear interpolation, as of sorted rows; nulls do not count.

    Equal values are counted before anything is ordered, and the counts are summed up within segments between
    approximate quantiles; so neither a frequent value nor a large table ends in one task.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("value")).agg(F.count("*").alias("n"))
    segments = segments_of(df.count())
    cuts = counts.agg(F.percentile_approx("value", F.array(*[F.lit(i / segments) for i in range(1, segments)])).alias("cuts"))
    placed = counts.join(F.broadcast(cuts)).withColumn("segment", F.size(F.filter("cuts", lambda c: c < F.col("value")))).drop("cuts")
    sizes = placed.groupBy("segment").agg(F.sum("n").alias("rows"))  # a row a segment
    before = F.coalesce(F.sum("rows").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("segment", before.alias("before"), F.sum("rows").over(Window.partitionBy()).alias("total"))
    upto = F.sum("n").over(Window.partitionBy("segment").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ends = placed.withColumn("upto", upto).join(F.broadcast(sizes), "segment").withColumn("end", F.col("before") + F.col("upto"))
    wanted = F.explode(F.array(*map(F.lit, shares))).alias("share")
    hits = ends.select("value", "end", (F.col("end") - F.col("n")).alias("start"), "total", wanted).withColumn("at", F.col("share") * (F.col("total") - 1))
    inside = lambda place: (F.col("start") <= place) & (place < F.col("end"))
    low, high = F.floor("at"), F.ceil("at")
    hits = hits.where(inside(low) | inside(high)).groupBy("share", "at").agg(F.max(F.when(inside(low), F.col("value"))).alias("l"), F.max(F.when(inside(high), F.col("value"))).alias("h"))
    return hits.select("share", (F.col("l") + (F.col("h") - F.col("l")) * (F.col("at") - F.floor("at"))).alias("value"))


def summary(df: DataFrame, column: str) -> DataFrame:
    """(n, low, mean, high, std) of the values that are not null."""
    return df.agg(F.count(column).alias("n"), F.min(column).alias("low"), F.avg(column).alias("mean"), F.max(column).alias("high"), F.stddev_samp(column).alias("std"))


def status_counts(df: DataFrame, cases: dict[str, Column], rest: str) -> DataFrame:
    """(status, n): rows by the first of the cases that holds; an unknown one does not."""
    status = F.lit(rest)
    for name, case in reversed(cases.items()):
        status = F.when(F.coalesce(case, F.lit(False)), name).otherwise(status)
    return df.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def error_frequency(df: DataFrame, truth: str, predicted: str, k: int = 10) -> DataFrame:
    """(truth, predicted, n): the k most frequent errors, of equal ones the smaller pair; null-safe."""
    wrong = df.where(~F.col(truth).eqNullSafe(F.col(predicted))).groupBy(truth, predicted).agg(F.count("*").alias("n"))
    return wrong.orderBy(F.col("n").desc(), truth, predicted).limit(k)


def rows_of_ids(df: DataFrame, ids: str, reference: DataFrame, id_: str) -> DataFrame:
    """Each row with each row of the reference that its list of ids names, once; rows without any go."""
    return df.withColumn(id_, F.explode(F.array_distinct(ids))).join(reference, id_)


def shared_and_rest(ids: Column, others: Column) -> tuple[Column, Column]:
    """The distinct values that both arrays have, and those that only the first has; sorted."""
    return F.array_sort(F.array_intersect(ids, others)), F.array_sort(F.array_except(ids, others))


def texts_of_groups(df: DataFrame, group: str, text: str, order: str) -> DataFrame:
    """(group, place, text, n): the texts of each group by order, from 0, and the group's size; rows, not one list, so that a group may be of any size."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    placed = df.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1)
    return placed.join(sizes, group).select(group, "place", F.col(text).alias("text"), "n")


def rows_of(df: DataFrame, key: str, wanted: list) -> DataFrame:
    """Rows whose key is in a list of the caller; the list goes into the plan and reaches the scan."""
    return df.where(F.col(key).isin(wanted))


def wide(df: DataFrame, vector: str, n: int, drop: tuple[str, ...] = ()) -> DataFrame:
    """The first n places of a vector as columns v0, v1 ... instead of it, without the columns that are not wanted."""
    kept = [c for c in df.columns if c not in (vector, *drop)]
    return df.select(*kept, *[F.get(vector, F.lit(i)).alias(f"v{i}") for i in range(n)])


def captured(df: DataFrame, column: str, f: Callable[[str], str | None], into: str) -> DataFrame:
    """f of a text as the column `into`, and the name of the exception that it raised as `error`; one row's error stops no other."""

    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out: list[tuple[str | None, str | None]] = []
            for text in texts:
                try:
                    out.append((f(text), None))
                except Exception as e:  # the error is the result
                    out.append((None, type(e).__name__))
            yield pd.DataFrame(out, columns=["value", "error"])

    judged.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}  # Spark reads types, not their names
    done = df.withColumn(into, F.pandas_udf(judged, "value string, error string")(F.col(column)))
    return done.withColumns({into: F.col(f"{into}.value"), "error": F.col(f"{into}.error")})


def with_entries(entries: Column, more: Column) -> Column:
    """A map with the entries of another one; of a key in both the other's value counts."""
    kept = F.map_filter(entries, lambda k, _: ~F.map_contains_key(more, k))
    return F.map_concat(kept, more)
