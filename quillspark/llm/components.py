"""Connected components of an edge table, as DataFrame operations.

Each round every node takes the neighbour of lowest rank (or itself) as its parent, and the graph is contracted
to the parents. Ranks are scrambled ids, so a constant share of the nodes goes each round whatever the shape: a
star in two rounds, a path of n nodes in about log n. Hot nodes spread: minima are pre-aggregated, and what joins
on a hot node is the large, splittable side. Joins are sort-merge joins throughout: an adaptive broadcast in each of
the many small steps would fill the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import discard, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame | None:
    """(node, root) for every node of the edges: equal roots exactly for connected nodes; a root is one of them.

    Nodes are 64-bit integers. Loops, repeated and reversed edges make no difference; rows with a null end are
    left out. None if there is no edge between different nodes. What the driver sees of it all is one count a round.
    """
    edges = edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).where("a <> b").distinct()
    edges = stored(edges)
    parents: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("r"), F.col(c).alias("id"))
        low = both.groupBy("a").agg(F.min(rank("b")).alias("low"))
        up = stored(low.select(F.col("a").alias("node"), F.least(rank("a"), F.col("low"))["id"].alias("up")))
        parents.append(up)
        left, right = (up.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}")) for c in "ab")
        moved = edges.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where("up_a <> up_b")
        moved = stored(moved.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct())
        discard(edges)
        edges = moved
    discard(edges)
    if not parents:
        return None
    out = parents[0].select("node", F.col("up").alias("root"))
    for up in parents[1:]:
        out = out.join(up.select(F.col("node").alias("root"), "up").hint("merge"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    out = stored(out)
    discard(*parents)
    return out
