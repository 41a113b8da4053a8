"""The inverted-file index against all pairs; which files a search opens."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import vector_index as V
from quillspark.plans.queries import QUERIES

SCHEMA = "id long, v array<double>"


def brute(rows, asked, k):
    ids = np.array([i for i, v in rows if v and any(v)])
    m = np.array([v for _, v in rows if v and any(v)])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    out = {}
    for i, v in asked:
        if v and any(v):
            cos = np.round(m @ (np.array(v) / np.linalg.norm(v)), 6)
            out[i] = [(int(ids[j]), round(float(cos[j]), 6)) for j in np.lexsort((ids, -cos)) if ids[j] != i][:k]
    return out


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.place)):
        out.setdefault(r.query_id, []).append((r.id, round(r.cos, 6)))
    return out


@pytest.fixture(scope="module")
def clustered():
    """Ten directions with spread, a third of the rows one and the same vector, and rows without a direction."""
    r = np.random.default_rng(3)
    centres = np.eye(12)[:10]
    rows = [(i, [float(x) for x in (centres[i % 10] + 0.08 * r.normal(size=12)) * (1 + i % 3)]) for i in range(400)]
    return rows + [(400 + i, [float(x) for x in centres[0]]) for i in range(200)] + [(600, None), (601, [0.0] * 12)]


def test_exact(spark, clustered, monkeypatch):
    """Equal to all pairs, ties by id, with a cell in several parts; most cells stay closed."""
    monkeypatch.setattr(V, "ROWS", 50)
    index = V.build(spark.createDataFrame(clustered, SCHEMA), "id", "v", 10)
    assert index.size.sum() == 600 and index.size.max() >= 200
    asked = [x for x in clustered if x[0] % 50 == 0]
    q = spark.createDataFrame(asked, SCHEMA)
    for k in (1, 7):
        assert grouped(V.search_exact(index, q, "id", "v", k).collect()) == brute(clustered, asked, k)
    assert grouped(V.search_exact(index, q, "id", "v", 500).collect()) == brute(clustered, asked, 500)
    near = V.search(index, q, "id", "v", 7, 1).select("query_id", F.col("cos").alias("least"))
    rest = V._queries(q, "id", "v").drop("least").join(near.groupBy("query_id").agg(F.min("least").alias("least")), "query_id").select("query_id", "q", "least")
    assert rest.mapInArrow(V._possible(index, 1), V.ASKED).count() < len(asked) * 2  # of nine other cells each


def test_pruned_files(spark, clustered):
    index = V.build(spark.createDataFrame(clustered, SCHEMA), "id", "v", 10)
    every, one = index.rows(spark).inputFiles(), index.rows(spark, [int(index.size.argmin())])
    assert len({f.split("cell=")[1].split("/")[0] for f in every}) == 10
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    files = one._jdf.queryExecution().executedPlan().execute().getNumPartitions()
    assert files <= 2 and one.count() == index.size.min()


def test_recall(spark, sf):
    exact, probed = ({(r.query_id, r.id) for r in QUERIES[n](spark, sf).collect()} for n in ("vector_topk", "probed_topk"))
    assert len(exact & probed) >= 0.9 * len(exact)


def test_empty(spark, clustered):
    index = V.build(spark.createDataFrame(clustered, SCHEMA), "id", "v", 4)
    none = spark.createDataFrame([], SCHEMA)
    assert V.search_exact(index, none, "id", "v", 3).count() == 0
    assert V.search_exact(index, spark.createDataFrame([(1, None)], SCHEMA), "id", "v", 3).count() == 0


def test_parts_of_a_search_lose_nothing(spark, monkeypatch):
    """Small parts and blocks give the hits of one product: by bound, by label, within a label and until the first weak one."""
    import numpy as np

    from quillspark.operators import search

    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random.integers(-2, 3, 4)], i % 3 if i % 7 else None) for i in range(60)] + [(60, None, 1), (61, [0.0] * 4, 1)]
    df = spark.createDataFrame(rows, "id long, v array<float>, label int")
    asked = df.where("id % 5 = 0")
    weak = lambda ids, cos: cos - (ids % 4) / 4 < 0.2

    def found():
        args = (df, asked, "id", "v")
        first = search.top_k(search.top_per_label(*args, "label", 2).join(df.select("id", "label"), "id"), 2, ["query_id", "label"])
        until = {}
        for r in sorted(search.until_weak(*args, weak).collect(), key=lambda r: (r.query_id, -r.cos, r.id)):
            if until.setdefault(r.query_id, [[], True])[1]:
                until[r.query_id][1] = not weak(r.id, r.cos)
                until[r.query_id][0].append(r.id)
        return [sorted(map(tuple, d.select("query_id", "id", "cos").collect())) for d in (search.scored(*args, 0.3), first, search.within_cluster(*args, "label"))] + [until]

    whole = found()
    monkeypatch.setattr(search, "PART", 7)
    monkeypatch.setattr(search, "BLOCK", 3)
    assert found() == whole and whole[0] and len(whole[2]) > 100
    label = {r[0]: r[2] for r in rows}
    assert all(label[q] == label[i] is not None for q, i, _ in whole[2])
