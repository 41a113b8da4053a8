"""Similar documents by embedding: a query set against all rows, in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import similarity as S
from quillspark.operators.groups import top_per_group
from quillspark.operators.vector_index import DIGITS, HITS, _matrix, best_of_part

#: Queries in a block: what one part of the corpus meets at once.
BLOCK = 256

#: Rows of the corpus in one multiplication, on average.
PART = 4096


def nearest(corpus: DataFrame, queries: DataFrame, id_: str, vector: str, k: int) -> DataFrame:
    """(query_id, id, cos, place): the k best other rows of each query, by one matrix product for each part of the corpus and block of queries, of which k rows a query are left. Vectors without a direction have no cosine."""
    parts, blocks = (max(1, -(-d.count() // size)) for d, size in ((corpus, PART), (queries, 4 * BLOCK)))
    pick = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    real = F.get("v", F.lit(0)).isNotNull()
    rows = corpus.select(F.col(id_).cast("long").alias("id"), S.l2_normalised(F.col(vector)).alias("v")).where(real).withColumns({"part": pick("id", parts), "block": numbers(blocks)})
    asked = queries.select(F.col(id_).cast("long").alias("query_id"), S.l2_normalised(F.col(vector)).alias("v")).where(real)
    asked = asked.select("query_id", F.col("v").alias("q"), F.lit(-2.0).alias("least"), pick("query_id", blocks).alias("block"), numbers(parts).alias("part"))
    hits = rows.groupBy("part", "block").cogroup(asked.groupBy("part", "block")).applyInArrow(best_of_part(k), HITS)
    return top_k(hits, k)


def _chosen(choose: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]):
    """A function of two Arrow tables, rows (id, v, of) and queries (query_id, q), for cogroup: (query_id, id, cos) of the rows that choose(ids, cosines, of) takes for each query."""

    def met(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, of = rows["id"].to_numpy(), rows["of"].to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        ids, of = ids[order], of[order]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(ids) and asked.num_rows:
            v, q, names = _matrix(rows["v"].combine_chunks())[order], _matrix(asked["q"].combine_chunks()), asked["query_id"].to_numpy()
            for name, row in zip(names, np.round(q @ v.T, DIGITS), strict=True):
                other = np.flatnonzero(ids != name)
                at = other[choose(ids[other], row[other], of[other])]
                out.append((np.full(len(at), name), ids[at], row[at]))
        return pa.table({n: np.concatenate([x[i] for x in out]) for i, n in enumerate(("query_id", "id", "cos"))})

    return met


def matched(corpus: DataFrame, queries: DataFrame, id_: str, vector: str, choose: Callable, of: str | None = None, within: bool = False) -> DataFrame:
    """(query_id, id, cos) of the other rows that choose(ids, cosines, of) takes for a query out of each part of the corpus, by one matrix product a part and block of queries.

    choose gets arrays in order of id and gives indices; rows that it leaves out are never written. `of` is a whole-number
    column of both sides that choose gets of the rows; with `within` only rows meet that have the query's. Vectors
    without a direction have no cosine.
    """
    parts, blocks = (max(1, -(-d.count() // size)) for d, size in ((corpus, PART), (queries, 4 * BLOCK)))
    pick = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    kind = F.col(of).cast("long") if of else F.lit(0).cast("long")
    keys = ["part", "block", "own"]
    own = kind if within else F.lit(0).cast("long")
    rows = corpus.select(F.col(id_).cast("long").alias("id"), S.l2_normalised(F.col(vector)).alias("v"), F.coalesce(kind, F.lit(-(1 << 62))).alias("of"), own.alias("own")).where(_real("v") & F.col("own").isNotNull())
    asked = queries.select(F.col(id_).cast("long").alias("query_id"), S.l2_normalised(F.col(vector)).alias("q"), own.alias("own")).where(_real("q") & F.col("own").isNotNull())
    rows = rows.withColumns({"part": pick("id", parts), "block": numbers(blocks)})
    asked = asked.withColumns({"block": pick("query_id", blocks), "part": numbers(parts)})
    return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_chosen(choose), HITS)


def _real(vector: str) -> Column:
    return F.get(vector, F.lit(0)).isNotNull()


def scored(corpus: DataFrame, queries: DataFrame, id_: str, vector: str, least: float = -2.0) -> DataFrame:
    """(query_id, id, cos) of every query and every other row of that cosine at least."""
    return matched(corpus, queries, id_, vector, lambda ids, cos, of: np.flatnonzero(cos >= least))


def _first_of_each(k: int):
    def choose(ids: np.ndarray, cos: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((ids, -cos, of))
        groups = of[order]
        start = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(order) else np.zeros(0, np.int64)
        place = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
        return order[place < k]

    return choose


def top_per_label(corpus: DataFrame, queries: DataFrame, id_: str, vector: str, label: str, k: int) -> DataFrame:
    """(query_id, id, cos): the k best other rows of each whole-number label for each query, and those that are only the best of a part."""
    return matched(corpus, queries, id_, vector, _first_of_each(k), of=label)


def until_weak(corpus: DataFrame, queries: DataFrame, id_: str, vector: str, weak: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(query_id, id, cos): other rows in order of cosine, then id, to the first of each part of the corpus that weak(ids, cosines) holds for, which is among them.

    The first weak row of all is not behind that of a part, so what a part leaves out is behind it, too.
    """

    def choose(ids: np.ndarray, cos: np.ndarray, of: np.ndarray) -> np.ndarray:
        bad = np.flatnonzero(weak(ids, cos))
        if not len(bad):
            return np.arange(len(ids))
        first = bad[np.lexsort((ids[bad], -cos[bad]))[0]]
        return np.flatnonzero((cos > cos[first]) | ((cos == cos[first]) & (ids <= ids[first])))

    return matched(corpus, queries, id_, vector, choose)


def top_k(pairs: DataFrame, k: int, by: list[str] | None = None) -> DataFrame:
    """The k best of each query; equal cosines by id."""
    w = Window.partitionBy(*(by or ["query_id"])).orderBy(F.col("cos").desc(), "id")
    return pairs.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def reranked(pairs: DataFrame, cross: Column, threshold: float) -> DataFrame:
    """Hits in order of cosine until the first whose mean of cosine and cross score is under the threshold."""
    blended = pairs.withColumn("score", (cross + F.col("cos")) / 2)
    w = Window.partitionBy("query_id").orderBy(F.col("cos").desc(), "id").rowsBetween(Window.unboundedPreceding, 0)
    return blended.withColumn("low", F.min("score").over(w)).where(F.col("low") >= threshold).drop("low")


def within_cluster(corpus: DataFrame, queries: DataFrame, id_: str, vector: str, cluster: str) -> DataFrame:
    """(query_id, id, cos) of other rows of the query's own cluster, a whole number; only these meet."""
    return matched(corpus, queries, id_, vector, lambda ids, cos, of: np.arange(len(ids)), of=cluster, within=True)


def top_cross(pairs: DataFrame, cross: Column, first: int = 30, k: int = 10) -> DataFrame:
    """Of the `first` best of each query by cosine the k best by cross score, with both places; ties by cosine, then id."""
    near = top_per_group(pairs, ["query_id"], [F.col("cos").desc(), F.col("id")], first).withColumnRenamed("place", "cos_place")
    return top_per_group(near.withColumn("cross", cross), ["query_id"], [F.col("cross").desc(), F.col("cos_place")], k)
