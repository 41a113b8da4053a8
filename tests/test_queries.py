"""Every query against its DuckDB SQL on the smallest tables; those without SQL for rows and invariants."""

import sys

import duckdb
import pytest

import __spark_entry__ as entry
from quillspark.functions import similarity as S
from quillspark.operators import cluster
from quillspark.plans.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return c


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return sorted([tuple(None if x is None or x != x else f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in frame.itertuples(index=False)], key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, db, name):
    got, want = QUERIES[name](spark, sf).toPandas(), db.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_without_training_data(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("quillspark.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "quillspark.llm", None)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(SQL)


def test_strings():
    assert S.lcs_length("abcbdab", "bdcaba") == 4 and S.indel("", "") == 100 and abs(S.indel("kitten", "sitting") - 100 * 8 / 13) < 1e-9
    assert S.token_sort("b a", "a b") == 100 and S.partial("abc", "xxabcxx") == 100 and S.partial("", "x") == 0
    assert abs(S.jaro("MARTHA", "MARHTA") - 0.944444) < 1e-6 and abs(S.jaro_winkler("MARTHA", "MARHTA") - 0.961111) < 1e-6 and S.jaro("", "a") == 0


def test_average_linkage(spark):
    """Linkage inside near components equals linkage over all rows."""
    import numpy as np

    v = np.random.default_rng(2).normal(size=(40, 3))
    rows = [(i, [float(x) for x in a]) for i, a in enumerate(v)]
    got = {r.id: r.cluster for r in cluster.average_linkage(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 0.1).collect()}
    assert got == dict(enumerate(cluster._linked(np.arange(40), v, 0.1).tolist()))
