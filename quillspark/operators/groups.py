"""Per-group choices, frequencies and prefixes, all with a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group; the order has to be total. Rank-limited, so that Spark filters before the shuffle."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("place = 1").drop("place")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= k)


def mode_mapping(df: DataFrame, source: str, target: str, more_than: int = 2) -> DataFrame:
    """Of each source its most frequent target (ties: the smallest), if the pair occurs often enough, with the count."""
    pairs = df.groupBy(source, target).agg(F.count("*").alias("n")).where(F.col("n") > more_than)
    return first_per_group(pairs, [source], [F.col("n").desc(), F.col(target)])


def value_counts(df: DataFrame, column: str, more_than: int = 0) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).where(F.col("n") > more_than)


def collapse_small(df: DataFrame, column: str, at_most: int = 10) -> DataFrame:
    """Groups with few rows become one group, numbered behind the largest."""
    sizes = df.groupBy(column).agg(F.count("*").alias("n"))
    top = sizes.agg((F.max(column) + 1).alias("rest"))
    mapped = sizes.join(F.broadcast(top)).select(column, F.when(F.col("n") <= at_most, F.col("rest")).otherwise(F.col(column)).alias("merged"))
    return df.join(mapped, column)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, n) of equal widths between minimum and maximum; the maximum is in the last bin. Bins without rows have none."""
    ends = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    placed = df.where(F.col(column).isNotNull()).join(F.broadcast(ends))
    at = F.floor((F.col(column) - F.col("low")) / ((F.col("high") - F.col("low")) / bins))
    at = F.when(F.col("high") == F.col("low"), F.lit(0)).otherwise(F.least(at, F.lit(bins - 1)))
    return placed.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def neighbours_of_best(df: DataFrame, keys: list[str], order: list[str], score: str, text: str, share: float = 0.3) -> DataFrame:
    """Of each group the text of its best row and of the rows next to it that have over `share` of its score, in order."""
    w = Window.partitionBy(*keys)
    placed = df.withColumn("at", F.row_number().over(w.orderBy(*order)))
    best = F.max(F.struct(F.col(score).alias("s"), (-F.col("at")).alias("a"))).over(w)
    near = placed.withColumn("best", best).where((F.abs(F.col("at") + F.col("best.a")) <= 1) & (F.col(score) > share * F.col("best.s")))
    parts = F.array_sort(F.collect_list(F.struct("at", text)))  # at most three rows
    return near.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p[text]), " ").alias("joined"), F.count("*").alias("n"))


def prefix_until(df: DataFrame, keys: list[str], order: list[Column], good: Column) -> DataFrame:
    """Rows before the first that is not good, in order."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("all_good", F.min(good.cast("int")).over(w)).where("all_good = 1").drop("all_good")


def until_limit(df: DataFrame, keys: list[str], order: list[Column], wanted: Column, limit: int) -> DataFrame:
    """Wanted rows until there are `limit` of them."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("so_far", F.sum(wanted.cast("int")).over(w)).where(wanted & (F.col("so_far") <= limit))


#: Rows of a segment that is ordered by itself, on average, and the least and greatest numbers of segments.
SEGMENT_ROWS, FEWEST, MOST = 2_000_000, 64, 4096


def segments_of(rows: int) -> int:
    return min(max(-(-rows // SEGMENT_ROWS), FEWEST), MOST)


def positions(df: DataFrame, key: str) -> DataFrame:
    """A column `position`: the row's place, from 0, in the order of a unique numeric key.

    Rows are ranked within segments between approximate quantiles, each a task of its own, and moved by the exact
    number of rows in the segments before; so no task sees all rows, and the quantiles need not be exact.
    """
    segments = segments_of(df.count())
    cuts = df.agg(F.percentile_approx(key, F.array(*[F.lit(i / segments) for i in range(1, segments)])).alias("cuts"))
    placed = df.join(F.broadcast(cuts)).withColumn("segment", F.size(F.filter("cuts", lambda c: c < F.col(key)))).drop("cuts")
    sizes = placed.groupBy("segment").agg(F.count("*").alias("n"))  # a row a segment
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy("segment").orderBy(key)))
    out = ranked.join(F.broadcast(before.drop("n")), "segment")
    return out.withColumn("position", F.col("before") + F.col("rank") - 1).drop("segment", "before", "rank")


def positional_split(df: DataFrame, key: str, share: float) -> DataFrame:
    """A column `part`: the first floor(n * share) rows in order of the key are train, the others test."""
    total = df.agg(F.floor(F.count("*") * F.lit(share)).alias("edge"))
    placed = positions(df, key).join(F.broadcast(total))
    return placed.withColumn("part", F.when(F.col("position") < F.col("edge"), "train").otherwise("test")).drop("edge", "position")


def hash_split(df: DataFrame, key: str, percent: int) -> DataFrame:
    """A stable random split by the MD5 of the key as text: the same rows at any partitioning, and in other systems."""
    draw = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("part", F.when(draw < percent, "train").otherwise("test"))


def bucketed(df: DataFrame, key: str, size: int) -> DataFrame:
    """A folder number for every `size` rows in order of the key, for write.partitionBy."""
    return positions(df, key).withColumn("folder", F.floor(F.col("position") / size) * size).drop("position")
