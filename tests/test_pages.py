"""Rectangles: the grid join against all pairs, a crowded page, one-to-one matching against a plain loop, average precision."""

import random

from pyspark.sql import functions as F

from quillspark.operators import boxes, detection

BOX = "doc_id long, page_num int, box_id long, cls string, proba double, x1 double, y1 double, x2 double, y2 double"


def some_boxes(n, seed, size=60, pages=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        x, y = r.randint(-40, 200), r.randint(-40, 200)
        out.append((r.randint(0, 1), r.randint(1, pages), i, r.choice(["text", "sender", "date"]), r.randint(0, 20) / 20, float(x), float(y), float(x + r.randint(0, size)), float(y + r.randint(0, size))))
    return out


def shared(a, b):
    w, h = min(a[7], b[7]) - max(a[5], b[5]), min(a[8], b[8]) - max(a[6], b[6])
    return w * h if a[:2] == b[:2] and w > 0 and h > 0 else 0


def test_overlaps(spark):
    """Every pair once, whatever the cell; rectangles without an area and nulls in none."""
    a, b = some_boxes(60, 1), some_boxes(80, 2)
    want = {(x[2], y[2]): shared(x, y) for x in a for y in b if shared(x, y)}
    odd = [(0, 1, 900, "text", 1.0, None, 1.0, 2.0, 3.0), (0, 1, 901, "text", 1.0, 5.0, 0.0, 1.0, 9.0)]
    for cell in (7.0, 32.0, 1000.0):
        got = boxes.overlapping(spark.createDataFrame(a + odd, BOX), spark.createDataFrame(b, BOX), cell).select("a.box_id", F.col("b.box_id").alias("other"), "area").collect()
        assert len(got) == len(want) and {(r.box_id, r.other): r.area for r in got} == want
    assert boxes.overlapping(spark.createDataFrame([], BOX), spark.createDataFrame(b, BOX)).count() == 0


def test_crowded_page(spark):
    """All blocks on one page: they meet the boxes in many cells, so no key of the join has a large part of the rows."""
    page = spark.createDataFrame([(0, 1, i, "text", 0.5, x, y, x + 30, y + 30) for i, (x, y) in enumerate((float(x), float(y)) for x in range(0, 600, 30) for y in range(0, 600, 30))], BOX)
    blocks = spark.range(4000).select(F.lit(0).cast("long").alias("doc_id"), F.lit(1).alias("page_num"), F.col("id").alias("block_seq"), F.lit("t").alias("text"))
    x, y = (F.col("block_seq") * 37 % 590).cast("double"), (F.col("block_seq") * 101 % 590).cast("double")
    blocks = blocks.withColumns({"x1": x, "y1": y, "x2": x + 9, "y2": y + 9})
    cells = boxes._in_cells(blocks, "b", boxes.CELL)
    assert cells.groupBy("cx", "cy").count().agg(F.max("count")).first()[0] < cells.count() / 50
    found = boxes.box_of_block(page, blocks)
    assert found.count() == 4000
    least = found.select("area").agg(F.min("area")).first()[0]
    assert least >= 81 / 4


def test_texts(spark):
    page = [(1, 1, 0, "text", 0.9, 0.0, 0.0, 10.0, 10.0), (1, 1, 1, "text", 0.4, 0.0, 10.0, 10.0, 20.0), (1, 1, 2, "date", 0.9, 50.0, 0.0, 60.0, 10.0), (1, 1, 3, "date", 0.2, 50.0, 20.0, 60.0, 30.0), (1, 1, 4, "signer", 0.5, 90.0, 90.0, 91.0, 91.0)]
    rows = [(1, 1, 1, "second\nline", 0.0, 1.0, 9.0, 5.0), (1, 1, 0, " first", 0.0, 0.0, 9.0, 1.0), (1, 1, 2, "third", 1.0, 12.0, 2.0, 14.0), (1, 1, 3, "01.02.2020", 51.0, 1.0, 55.0, 9.0), (1, 1, 4, "02.02.2020", 51.0, 21.0, 55.0, 29.0), (1, 1, 5, "outside", 200.0, 0.0, 210.0, 9.0), (2, 1, 0, "other", 0.0, 0.0, 1.0, 1.0)]
    b = spark.createDataFrame(rows, "doc_id long, page_num int, block_seq int, text string, x1 double, y1 double, x2 double, y2 double")
    d = spark.createDataFrame(page, BOX)
    got = {r.box_id: (r.text, r.n_blocks) for r in boxes.texts_of_boxes(d, b).collect()}
    assert got == {0: ("first second line", 2), 1: ("third", 1), 2: ("01.02.2020", 1), 3: ("02.02.2020", 1), 4: ("", 0)}
    by_hand = boxes.texts_of_boxes(d.withColumn("handwritten", F.col("box_id") > 1), b)
    fields = {r.cls: (r.text, r.proba) for r in boxes.page_texts(by_hand).collect()}
    assert fields == {"text": ("first second line third", 0.4), "date": ("handwrite", 0.9), "signer": ("", 0.5)}


def plain_matches(truth, predicted, least):
    taken, out = set(), {}
    for p in sorted(predicted, key=lambda x: (-x[4], x[:3])):
        best = None
        for t in truth:
            s = shared(p, t)
            iou = s / ((p[7] - p[5]) * (p[8] - p[6]) + (t[7] - t[5]) * (t[8] - t[6]) - s) if s else 0
            if p[3] == t[3] and t[2] not in taken and iou >= least and s and (best is None or (-iou, t[2]) < best):
                best = (-iou, t[2])
        if best:
            taken.add(best[1])
        out[p[2]] = best[1] if best else None
    return out


def test_matching(spark):
    for seed, least in ((3, 0.1), (4, 0.3), (5, 0.5)):
        truth, predicted = some_boxes(70, seed, pages=2), some_boxes(120, seed + 50, pages=2)
        got = detection.matched(spark.createDataFrame(truth, BOX), spark.createDataFrame(predicted, BOX), least)
        assert {r.box_id: r.matched_id for r in got.collect()} == plain_matches(truth, predicted, least)
    none = detection.matched(spark.createDataFrame([], BOX), spark.createDataFrame(predicted, BOX))
    assert none.count() == 120 and none.where("matched_id is not null").count() == 0


def test_many_boxes_on_one(spark):
    """Equal boxes over one true box: the first by score and id takes it, in one round."""
    predicted = [(0, 1, i, "text", 0.5 if i else 0.4, 0.0, 0.0, 10.0, 10.0) for i in range(300)]
    got = detection.matched(spark.createDataFrame([(0, 1, 7, "text", 1.0, 0.0, 0.0, 10.0, 9.0)], BOX), spark.createDataFrame(predicted, BOX))
    assert [r.box_id for r in got.where("matched_id = 7").collect()] == [1]


def test_average_precision(spark):
    r = random.Random(9)
    rows = [("abc"[i % 3], r.randint(0, 60) / 60, r.random() < 0.6) for i in range(400)]
    truths = {"a": 90, "b": 200, "c": 400, "d": 3}
    points = detection.curve(spark.createDataFrame(rows, "cls string, score double, hit boolean"), spark.createDataFrame(list(truths.items()), "cls string, positives long"))
    got = {x.cls: x for x in detection.average_precision(points, spark.createDataFrame(list(truths.items()), "cls string, positives long")).collect()}
    for cls, positives in truths.items():
        curve = []
        for score in sorted({s for c, s, _ in rows if c == cls}, reverse=True):
            taken = [h for c, s, h in rows if c == cls and s >= score]
            curve.append((sum(taken), len(taken)))
        ap, before = 0.0, 0
        for i, (tp, _) in enumerate(curve):
            ap += (tp - before) / positives * max(t / n for t, n in curve[i:])
            before = tp
        assert abs(got[cls].ap - ap) < 1e-9 and got[cls].tp == (curve[-1][0] if curve else 0)


def test_rectangles_meet_once_unless_crowded(spark, monkeypatch):
    """A page with few pairs takes no cells; the same pairs are found on a crowded one."""
    a = spark.createDataFrame([(d, 1, i, "text", 0.9, 0.0, 0.0, 300.0 + i, 300.0) for d in (1, 2) for i in range(3 * d)], BOX)
    b = spark.createDataFrame([(d, 1, i, "text", 0.9, 10.0 * i, 5.0, 10.0 * i + 40, 50.0) for d in (1, 2) for i in range(4)], BOX)
    found = []
    for most, celled in ((10_000, 0), (15, 1), (0, 1)):  # none, one, and both of the pages are crowded
        calls = []
        monkeypatch.setattr(boxes, "CROWDED", most)
        monkeypatch.setattr(boxes, "_in_cells", lambda *x, real=boxes._in_cells, calls=calls: calls.append(1) or real(*x))
        found.append(sorted(map(tuple, boxes.overlapping(a, b).select("a.doc_id", "a.box_id", F.col("b.box_id").alias("other"), "area").collect())))
        assert len(calls) == 2 * celled
        monkeypatch.undo()
    assert len(found[0]) == 9 * 4 and found[0] == found[1] == found[2]


def test_curve_has_no_frame_to_the_end(spark):
    """Spark works such a frame out anew for each row, which is quadratic."""
    rows = spark.createDataFrame([("a", 0.9, True), ("a", 0.8995, False), ("a", 0.8991, True), ("a", 0.1, True)], "cls string, score double, hit boolean")
    out = detection.curve(rows, spark.createDataFrame([("a", 4)], "cls string, positives long"))
    assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r.score: round(r.envelope, 6) for r in out.collect()} == {0.9: 1.0, 0.8995: 0.75, 0.8991: 0.75, 0.1: 0.75}


def test_rectangles_apart_have_no_ratio(spark):
    """Rectangles of a page whose distances across and up multiply to the sum of their areas; of ratios only those of overlapping ones are asked for."""
    page = spark.createDataFrame([(k, 1, i, "text", 0.5, *c) for k in range(20) for i, c in enumerate([(0.0, 0.0, 2.0, 2.0), (4.0, 6.0, 6.0, 8.0)])], BOX)
    found = detection.matched(page, page, 0.25).select("doc_id", "box_id", "matched_id", "iou").collect()
    assert len(found) == 40 and all(r.matched_id == r.box_id and r.iou == 1.0 for r in found)
