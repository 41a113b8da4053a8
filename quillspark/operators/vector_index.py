"""Inverted-file search: vectors stored in a folder for each nearest centroid; a query reads a few folders, or all that a bound cannot rule out.

On unit vectors a cosine is 1 - d ** 2 / 2 of the Euclidean distance d, which obeys the triangle inequality: no vector
of a cell is nearer to a query than the centroid is, less the cell's radius.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import similarity as S
from quillspark.sources.durable import checkpoint_folder, kept

#: Rows that the centroids are fitted on at most, those of the smallest hashes; every row is indexed.
SAMPLE = 50_000
#: Vectors and queries that meet in one multiplication, on average.
ROWS, QUERIES = 4096, 1024
#: Cosines are compared as they are given, to six digits.
DIGITS, SLACK = 6, 2e-6
HITS = "query_id long, id long, cos double"


@dataclass
class VectorIndex:
    """A stored index: rows (id, v, r) by cell at path; of each cell its centroid, radius and number of rows."""

    path: str
    centroids: np.ndarray
    radius: np.ndarray
    size: np.ndarray

    def rows(self, spark: SparkSession, cells: list[int] | None = None) -> DataFrame:
        """The vectors of some cells; files of the others are not opened."""
        rows = spark.read.schema("id long, v array<double>, r double, cell int").parquet(f"{self.path}/rows")
        return rows if cells is None else rows.where(F.col("cell").isin(cells))


def _unit(vector: str) -> Column:
    return S.l2_normalised(F.col(vector))


def _distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((v * v).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * v @ c.T, 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def build(df: DataFrame, id_: str, vector: str, cells: int, path: str | None = None, sample: int = SAMPLE, seed: int = 42) -> VectorIndex:
    """Stores every vector of df by its nearest of `cells` centroids. Vectors without a direction (null, zero) are not stored, as they have no cosine."""
    spark = df.sparkSession
    path = path or f"{checkpoint_folder(spark)}/vectors/{uuid.uuid4().hex}"
    rows = df.select(F.col(id_).cast("long").alias("id"), _unit(vector).alias("v")).where(F.get("v", F.lit(0)).isNotNull())
    few = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select(array_to_vector("v").alias("features"))
    centroids = np.array(KMeans(k=cells, seed=seed).fit(few).clusterCenters())

    def placed(batches):
        for batch in batches:
            v = _matrix(batch.column("v"))
            d = _distances(v, centroids) if len(v) else np.zeros((0, len(centroids)))
            cell = d.argmin(1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(d[np.arange(len(d)), cell]), pa.array(cell.astype(np.int32))], names=["id", "v", "r", "cell"])

    dealt = rows.mapInArrow(placed, "id long, v array<double>, r double, cell int").hint("rebalance", "cell")  # a large cell is several files
    dealt.write.partitionBy("cell").parquet(f"{path}/rows")
    radius, size = np.zeros(len(centroids)), np.zeros(len(centroids), np.int64)
    for r in VectorIndex(path, centroids, radius, size).rows(spark).groupBy("cell").agg(F.max("r").alias("r"), F.count("*").alias("n")).collect():  # a row a cell
        radius[r.cell], size[r.cell] = r.r, r.n
    return VectorIndex(path, centroids, radius, size)


def _nearest(index: VectorIndex, probes: int):
    """(cell, query_id, q, least) of each query's nearest cells."""
    centroids, full = index.centroids, np.flatnonzero(index.size)

    def chosen(batches):
        for batch in batches:
            d = _distances(_matrix(batch.column("q")), centroids[full])
            order = np.argsort(d, axis=1, kind="stable")[:, :probes]
            row = np.repeat(np.arange(len(d)), order.shape[1])
            yield _asked(batch, row, full[order.ravel()])

    return chosen


def _asked(batch: pa.RecordBatch, row: np.ndarray, cell: np.ndarray) -> pa.RecordBatch:
    at = pa.array(row)
    return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *[batch.column(c).take(at) for c in ("query_id", "q", "least")]], names=["cell", "query_id", "q", "least"])


def _possible(index: VectorIndex, probes: int):
    """(cell, query_id, q, least) of the cells behind the nearest `probes` that may hold a vector of cosine `least`."""
    centroids, radius, full = index.centroids, index.radius, np.flatnonzero(index.size)

    def chosen(batches):
        for batch in batches:
            d = _distances(_matrix(batch.column("q")), centroids[full])
            rank = np.argsort(np.argsort(d, axis=1, kind="stable"), axis=1)
            best = 1 - np.maximum(d - radius[full], 0) ** 2 / 2
            row, at = np.nonzero((rank >= probes) & (best + SLACK >= batch.column("least").to_numpy()[:, None]))
            yield _asked(batch, row, full[at])

    return chosen


def best_of_part(k: int):
    """A function of two Arrow tables, rows (id, v) and queries (query_id, q, least), for cogroup."""

    def best(rows: pa.Table, asked: pa.Table) -> pa.Table:
        """The k best rows of a part of a cell for each query that asks it."""
        none = pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "cos": pa.array([], pa.float64())})
        if not rows.num_rows or not asked.num_rows:
            return none
        ids = rows["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], _matrix(rows["v"].combine_chunks())[order]
        q, names, least = _matrix(asked["q"].combine_chunks()), asked["query_id"].to_numpy(), asked["least"].to_numpy()
        out = []
        for low in range(0, len(q), QUERIES):
            cos = np.round(q[low : low + QUERIES] @ v.T, DIGITS)
            cos[names[low : low + QUERIES, None] == ids[None]] = -9
            for i, row in enumerate(cos):
                at = np.argsort(-row, kind="stable")[:k]  # equal cosines by id
                at = at[(row[at] >= least[low + i]) & (row[at] > -9)]
                out.append((np.full(len(at), names[low + i]), ids[at], row[at]))
        return pa.table({n: np.concatenate([x[i] for x in out]) for i, n in enumerate(("query_id", "id", "cos"))})

    return best


def _search(index: VectorIndex, asked: DataFrame, k: int) -> DataFrame:
    """The k best of each query in each part of the cells asked."""
    spark = asked.sparkSession
    cells = sorted(r.cell for r in asked.select("cell").distinct().collect())  # no more than there are cells
    parts = F.element_at(F.array(*[F.lit(max(1, -(-int(n) // ROWS))) for n in index.size]), F.col("cell") + 1)
    rows = index.rows(spark, cells).withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("long"))
    each = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long"))))
    return rows.groupBy("cell", "part").cogroup(each.groupBy("cell", "part")).applyInArrow(best_of_part(k), HITS)


def _placed(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("cos").desc(), "id")
    return hits.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _queries(queries: DataFrame, id_: str, vector: str) -> DataFrame:
    q = queries.select(F.col(id_).cast("long").alias("query_id"), _unit(vector).alias("q"), F.lit(-2.0).alias("least"))
    return q.where(F.get("q", F.lit(0)).isNotNull())


ASKED = "cell int, query_id long, q array<double>, least double"


def search(index: VectorIndex, queries: DataFrame, id_: str, vector: str, k: int, probes: int) -> DataFrame:
    """(query_id, id, cos, place): the k best other rows in the `probes` nearest cells of each query; some of the best may lie in others."""
    asked = kept(_queries(queries, id_, vector).mapInArrow(_nearest(index, probes), ASKED))
    return _placed(_search(index, asked, k), k)


def search_exact(index: VectorIndex, queries: DataFrame, id_: str, vector: str, k: int, probes: int = 1) -> DataFrame:
    """(query_id, id, cos, place): the k best other rows of all. The nearest cells give each query a cosine that its best have at least; of the others only those are read that may have it."""
    q = _queries(queries, id_, vector)
    near = kept(_search(index, kept(q.mapInArrow(_nearest(index, probes), ASKED)), k))
    least = _placed(near, k).where(F.col("place") == k).select("query_id", F.col("cos").alias("least"))
    rest = q.drop("least").join(least, "query_id", "left").select("query_id", "q", F.coalesce("least", F.lit(-2.0)).alias("least"))
    asked = kept(rest.mapInArrow(_possible(index, probes), ASKED))
    return _placed(near.unionByName(_search(index, asked, k)), k)
