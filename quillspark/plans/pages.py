"""Queries over pages of rectangles: text by box, matches of a detector, precision-recall curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import boxes as B
from quillspark.operators import detection, entities
from quillspark.plans.queries import query
from quillspark.sources.readers import table

#: Eight orders make a page. Each order is a detected box, each line item a block of text; the corners are whole numbers.
DETECTED = """SELECT o_orderkey // 8 AS doc_id, 1 AS page_num, o_orderkey AS box_id, CASE o_orderstatus WHEN 'F' THEN 'text' WHEN 'O' THEN 'sender' ELSE 'signer' END AS cls, o_totalprice / 1000000.0::DOUBLE AS proba,
    o_custkey % 60 AS x1, (o_custkey * 7) % 60 AS y1, o_custkey % 60 + 20 + o_orderkey % 41 AS x2, (o_custkey * 7) % 60 + 15 + (o_orderkey * 3) % 47 AS y2 FROM orders"""
BLOCKS = """SELECT l_orderkey // 8 AS doc_id, 1 AS page_num, row_number() OVER (PARTITION BY l_orderkey // 8 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS block_seq,
    l_partkey || CHR(10) || l_returnflag AS text, l_partkey % 90 AS x1, l_suppkey % 90 AS y1, l_partkey % 90 + 8 + l_linenumber AS x2, l_suppkey % 90 + 5 AS y2 FROM lineitem"""
SHARED = """greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"""
BEST = f"""SELECT doc_id, page_num, block_seq, text, box_id, shared FROM (SELECT b.doc_id, b.page_num, block_seq, text, box_id, {SHARED} AS shared,
    row_number() OVER (PARTITION BY b.doc_id, b.page_num, block_seq ORDER BY {SHARED} DESC, proba DESC, box_id) AS r FROM d a JOIN k b ON a.doc_id = b.doc_id AND a.page_num = b.page_num) WHERE r = 1 AND shared > 0"""
PAGE_WITH = f"WITH d AS MATERIALIZED ({DETECTED}), k AS MATERIALIZED ({BLOCKS}), f AS ({BEST})"


def _detected(spark: SparkSession, sf: str) -> DataFrame:
    o, at = table(spark, sf, "orders"), {"x": F.col("o_custkey") % 60, "y": F.col("o_custkey") * 7 % 60}
    cls = F.when(F.col("o_orderstatus") == "F", "text").when(F.col("o_orderstatus") == "O", "sender").otherwise("signer")
    return o.select(
        F.expr("o_orderkey div 8").alias("doc_id"), F.lit(1).alias("page_num"), F.col("o_orderkey").alias("box_id"), cls.alias("cls"), (F.col("o_totalprice") / 1000000.0).alias("proba"),
        at["x"].alias("x1"), at["y"].alias("y1"), (at["x"] + 20 + F.col("o_orderkey") % 41).alias("x2"), (at["y"] + 15 + F.col("o_orderkey") * 3 % 47).alias("y2"),
    )


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    li, x, y = table(spark, sf, "lineitem"), F.col("l_partkey") % 90, F.col("l_suppkey") % 90
    rows = li.withColumn("doc_id", F.expr("l_orderkey div 8"))
    seq = F.expr("row_number() over (partition by doc_id order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)")
    text = F.concat(F.col("l_partkey").cast("string"), F.lit("\n"), F.col("l_returnflag"))
    return rows.select("doc_id", F.lit(1).alias("page_num"), seq.alias("block_seq"), text.alias("text"), x.alias("x1"), y.alias("y1"), (x + 8 + F.col("l_linenumber")).alias("x2"), (y + 5).alias("y2"))


@query(f"{PAGE_WITH} SELECT doc_id, block_seq, box_id, shared::DOUBLE AS area FROM f")
def box_of_block(spark, sf):
    """Each block with the box that shares most with it."""
    out = B.box_of_block(_detected(spark, sf), _blocks(spark, sf))
    return out.select("block.doc_id", F.col("block.block_seq").cast("bigint").alias("block_seq"), "box.box_id", "area")


TEXTS = f"{PAGE_WITH}, t AS (SELECT doc_id, page_num, box_id, string_agg(replace(text, CHR(10), ' '), ' ' ORDER BY block_seq) AS text, count(*) AS n FROM f GROUP BY ALL), w AS (SELECT d.*, coalesce(t.text, '') AS text, coalesce(n, 0) AS n FROM d LEFT JOIN t USING (doc_id, page_num, box_id))"


@query(f"{TEXTS} SELECT box_id, cls, text, n AS n_blocks FROM w")
def text_by_box(spark, sf):
    """The text of each detected box."""
    return B.texts_of_boxes(_detected(spark, sf), _blocks(spark, sf)).select("box_id", "cls", "text", "n_blocks")


@query(f"""{TEXTS}, p AS (SELECT doc_id, cls, coalesce(CASE WHEN cls = 'text' THEN string_agg(nullif(text, ''), ' ' ORDER BY box_id) ELSE arg_max(text, (proba, -box_id)) END, '') AS text, CASE WHEN cls = 'text' THEN arg_max(proba, box_id) ELSE max(proba) END AS proba FROM w GROUP BY doc_id, cls)
    SELECT doc_id, max(text) FILTER (cls = 'text') AS text, round(coalesce(max(proba) FILTER (cls = 'text'), 0), 6) AS text_proba, max(text) FILTER (cls = 'sender') AS sender, round(coalesce(max(proba) FILTER (cls = 'sender'), 0), 6) AS sender_proba,
    max(text) FILTER (cls = 'signer') AS signer, round(coalesce(max(proba) FILTER (cls = 'signer'), 0), 6) AS signer_proba FROM p GROUP BY doc_id""")
def page_fields(spark, sf):
    """Boxes to the fields of a document: best box of each class, texts joined, classes as columns."""
    merged = entities.merge_pages(B.page_texts(B.texts_of_boxes(_detected(spark, sf), _blocks(spark, sf))))
    flat = entities.flat_classes(merged, ["text", "sender", "signer"])
    return flat.select("doc_id", *[c for k in ("text", "sender", "signer") for c in (F.col(k), F.round(f"{k}_proba", 6).alias(f"{k}_proba"))])


@query(f"""WITH d AS ({DETECTED}) SELECT doc_id, arg_min(box_id, (page_num, box_id)) AS any_box, coalesce(arg_min(box_id, (page_num, box_id)) FILTER (cls = 'signer'), -1) AS signer_box FROM d GROUP BY doc_id""")
def first_boxes(spark, sf):
    """The first box of a document, of any class and of one."""
    d = _detected(spark, sf)
    every, signer = (B.first_box(d, c).select("doc_id", F.col("box_id").alias(n)) for c, n in ((None, "any_box"), ("signer", "signer_box")))
    return every.join(signer, "doc_id", "left").withColumn("signer_box", F.coalesce("signer_box", F.lit(-1)))


#: Orders as predicted boxes against orders of the same page as true ones, moved a little.
TRUE = """SELECT doc_id, page_num, box_id, cls, x1 + d AS x1, y1 + d // 2 AS y1, x2 + d AS x2, y2 + d // 2 AS y2 FROM (SELECT *, (box_id * 5 + x1) % 9 AS d FROM d)"""
MATCHED = f"""WITH RECURSIVE d AS MATERIALIZED ({DETECTED}), t AS ({TRUE}),
    p AS (SELECT a.doc_id, a.box_id AS p, b.box_id AS t, a.proba, {SHARED} AS shared, (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS whole FROM d a JOIN t b ON a.doc_id = b.doc_id AND a.cls = b.cls),
    i AS (SELECT doc_id, p, t, proba, shared / (whole - shared)::DOUBLE AS iou FROM p WHERE shared > 0 AND shared / (whole - shared)::DOUBLE >= 0.25),
    c AS MATERIALIZED (SELECT doc_id, p, list(t ORDER BY iou DESC, t) AS wanted, row_number() OVER (PARTITION BY doc_id ORDER BY any_value(proba) DESC, p) AS k FROM i GROUP BY doc_id, p),
    s(doc_id, k, p, t, taken) AS (SELECT doc_id, 0::BIGINT, NULL::BIGINT, NULL::BIGINT, []::BIGINT[] FROM (SELECT DISTINCT doc_id FROM c)
        UNION ALL SELECT doc_id, k, p, free[1], CASE WHEN len(free) > 0 THEN list_append(taken, free[1]) ELSE taken END FROM (SELECT s.doc_id, c.k, c.p, taken, list_filter(c.wanted, lambda x: NOT list_contains(taken, x)) AS free FROM s JOIN c ON s.doc_id = c.doc_id AND c.k = s.k + 1)),
    m AS (SELECT d.box_id, d.cls, d.proba, s.t AS matched_id, i.iou FROM d LEFT JOIN s ON d.box_id = s.p LEFT JOIN i ON i.p = s.p AND i.t = s.t)"""


def _true(spark: SparkSession, sf: str) -> DataFrame:
    d = (F.col("box_id") * 5 + F.col("x1")) % 9
    half = F.floor(d / 2)
    return _detected(spark, sf).select("doc_id", "page_num", "box_id", "cls", (F.col("x1") + d).alias("x1"), (F.col("y1") + half).alias("y1"), (F.col("x2") + d).alias("x2"), (F.col("y2") + half).alias("y2"))


@query(f"{MATCHED} SELECT box_id, coalesce(matched_id, -1) AS matched_id, round(coalesce(iou, 0), 9) AS iou FROM m")
def detector_matches(spark, sf):
    """Each predicted box with the true box that it takes, in order of score."""
    return detection.matched(_true(spark, sf), _detected(spark, sf), 0.25).select("box_id", F.coalesce("matched_id", F.lit(-1)).alias("matched_id"), F.round(F.coalesce("iou", F.lit(0.0)), 9).alias("iou"))


CURVE = """a AS (SELECT cls, score, sum(hit::INT) AS hits, count(*) AS rows FROM g GROUP BY cls, score), b AS (SELECT *, sum(hits) OVER w AS tp, sum(rows) OVER w AS n FROM a WINDOW w AS (PARTITION BY cls ORDER BY score DESC)),
    e AS (SELECT *, tp / n::DOUBLE AS precision, tp / positives::DOUBLE AS recall FROM b JOIN z USING (cls)), v AS (SELECT *, max(precision) OVER (PARTITION BY cls ORDER BY score) AS envelope FROM e)"""


@query(f"""{MATCHED}, g AS (SELECT cls, proba AS score, matched_id IS NOT NULL AS hit FROM m), z AS (SELECT cls, count(*) AS positives FROM t GROUP BY cls), {CURVE}
    SELECT cls, positives, max(n)::BIGINT AS predicted, max(tp)::BIGINT AS tp, round(max(tp) / max(n)::DOUBLE, 9) AS precision, round(max(tp) / positives::DOUBLE, 9) AS recall, round(sum(hits * envelope) / positives, 9) AS ap FROM v GROUP BY cls, positives""")
def detector_quality(spark, sf):
    """Precision, recall and average precision of each class."""
    out = detection.evaluate(_true(spark, sf), _detected(spark, sf), 0.25)
    return out.select("cls", "positives", "predicted", "tp", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "ap")])


@query(f"""WITH g AS (SELECT l_returnflag AS cls, round(l_discount * 8 + l_quantity / 1000, 6) AS score, l_linestatus = 'F' AS hit FROM lineitem), z AS (SELECT l_returnflag AS cls, count(*) AS positives FROM lineitem GROUP BY 1), {CURVE}
    SELECT cls, score, tp::BIGINT AS tp, n::BIGINT AS n, round(precision, 9) AS precision, round(recall, 9) AS recall, round(envelope, 9) AS envelope FROM v""")
def precision_recall_curve(spark, sf):
    """The curve itself, over line items as predictions of a class."""
    li = table(spark, sf, "lineitem")
    rows = li.select(F.col("l_returnflag").alias("cls"), F.round(F.col("l_discount") * 8 + F.col("l_quantity") / 1000, 6).alias("score"), (F.col("l_linestatus") == "F").alias("hit"))
    out = detection.curve(rows, li.groupBy(F.col("l_returnflag").alias("cls")).agg(F.count("*").alias("positives")))
    return out.select("cls", "score", "tp", "n", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "envelope")])
