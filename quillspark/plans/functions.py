"""Queries in SQL text, with the library's functions under their SQL names."""

from __future__ import annotations

from quillspark.functions import tables
from quillspark.plans.queries import SQL, query
from quillspark.sources.readers import table


def _sql(spark, sf, names: list[str], text: str):
    """The text with {name} as a view of the table of that name."""
    tables.register(spark)
    return spark.sql(text, **{n: table(spark, sf, n) for n in names})


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS x, round(embedding[2]::DOUBLE, 6) AS y, round(embedding[64]::DOUBLE, 6) AS last FROM embeddings")
def lateral_columns(spark, sf):
    """A table function that takes its columns from its argument, joined to each row."""
    names = ",".join(["x", "y", *[f"v{i}" for i in range(2, 63)], "last"])
    return _sql(spark, sf, ["embeddings"], f"""SELECT vec_id, round(CAST(x AS DOUBLE), 6) AS x, round(CAST(y AS DOUBLE), 6) AS y, round(CAST(last AS DOUBLE), 6) AS last FROM {{embeddings}}, LATERAL named_values(embedding, '{names}')""")


@query(SQL["case_islands"])
def partitioned_islands(spark, sf):
    """A table function over the lines of each document, in order."""
    return _sql(spark, sf, ["documents"], """WITH lines AS (SELECT doc_id, pos, line FROM {documents} LATERAL VIEW posexplode(split(text, '\n')) AS pos, line)
        SELECT doc_id, island, md5(text) AS digest FROM case_islands(TABLE(lines), 'doc_id', 'pos', 'line')""")


@query("""SELECT gram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM (SELECT list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM conversations)) GROUP BY gram HAVING count(*) > 1""")
def lateral_ngrams(spark, sf):
    """Pairs of neighbouring words that occur more than once."""
    return _sql(spark, sf, ["conversations"], "SELECT gram, count(*) AS n FROM {conversations}, LATERAL word_ngrams(text, 2) GROUP BY gram HAVING count(*) > 1")


@query("""SELECT p_partkey, round(j + 0.1 * (1 - j) * CASE WHEN a[1:4] = b[1:4] THEN 4 WHEN a[1:3] = b[1:3] THEN 3 WHEN a[1:2] = b[1:2] THEN 2 WHEN a[1] = b[1] THEN 1 ELSE 0 END, 6) AS sim
    FROM (SELECT p_partkey, p_name AS a, lower(p_type) AS b, jaro_similarity(p_name, lower(p_type)) AS j FROM part)""")
def registered_similarity(spark, sf):
    return _sql(spark, sf, ["part"], "SELECT p_partkey, round(jaro_winkler(p_name, lower(p_type)), 6) AS sim FROM {part}")
