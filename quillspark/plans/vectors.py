"""Queries of the inverted-file index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.operators import vector_index as V
from quillspark.plans.queries import SQL, query
from quillspark.sources.readers import table

CELLS, PROBES = 32, 20


def _index(spark: SparkSession, sf: str) -> tuple[V.VectorIndex, DataFrame]:
    e = table(spark, sf, "embeddings")
    return V.build(e, "vec_id", "embedding", CELLS), e.where("vec_id % 50 = 0")


@query(SQL["vector_topk"])
def indexed_topk(spark, sf):
    """The five nearest rows, exactly: cells are left out only by the triangle bound."""
    index, asked = _index(spark, sf)
    return V.search_exact(index, asked, "vec_id", "embedding", 5)


@query()
def probed_topk(spark, sf):
    """The five nearest rows of the 20 nearest cells."""
    index, asked = _index(spark, sf)
    return V.search(index, asked, "vec_id", "embedding", 5, PROBES)
