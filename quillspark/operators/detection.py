"""Quality of a detector: one-to-one matches of predicted and true boxes, precision-recall curves, average precision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.boxes import CELL, overlap_ratio, overlapping
from quillspark.sources.durable import checkpointed

#: Bins of a score between 0 and 1, within which a class's points are ordered; sums go from bin to bin.
BINS = 1024
BOX = ("doc_id", "page_num", "box_id")


def matched(truth: DataFrame, predicted: DataFrame, least: float = 0.5, cell: float = CELL) -> DataFrame:
    """predicted with matched_id (box_id of the true box, null if none) and iou: in order of score, each takes the free true box of its page and class that it overlaps most.

    Both have doc_id, page_num, box_id, cls and corners; predicted has proba. Equal scores go by box_id, equal ratios by
    the true box's. The order is only kept where it matters: in each round all predictions choose that are first at each
    true box they overlap; chosen boxes and those who chose go. So a page with many boxes is no task by itself.
    """
    pairs = overlap_ratio(overlapping(predicted, truth, cell).where("a.cls = b.cls")).where(F.col("iou") >= least)
    ref = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in BOX])
    live = checkpointed(pairs.select(ref("a").alias("p"), ref("b").alias("t"), F.col("a.proba").alias("proba"), "iou"))
    rounds = []
    while not live.isEmpty():
        ahead = live.groupBy("t").agg(F.min(F.struct(-F.col("proba"), F.col("p"))).alias("ahead"))
        able = live.join(ahead, "t").withColumn("able", F.col("ahead.p") == F.col("p"))
        chosen = able.groupBy("p").agg(F.min("able").alias("able"), F.min(F.struct(-F.col("iou"), F.col("t"))).alias("best")).where("able")
        chosen = checkpointed(chosen.select("p", F.col("best.t").alias("t"), (-F.col("best.col1")).alias("iou")))
        rounds.append(chosen)
        live = checkpointed(live.join(chosen.select("p"), "p", "left_anti").join(chosen.select("t"), "t", "left_anti"))
    flat = F.struct(*[F.col(c) for c in BOX])
    if not rounds:
        return predicted.withColumns({"matched_id": F.lit(None).cast(truth.schema["box_id"].dataType), "iou": F.lit(None).cast("double")})
    every = reduce(DataFrame.unionByName, rounds).select("p", F.col("t.box_id").alias("matched_id"), "iou")
    return predicted.withColumn("p", flat).join(every, "p", "left").drop("p")


def curve(predictions: DataFrame, truths: DataFrame) -> DataFrame:
    """(cls, score, tp, n, precision, recall, envelope): a point for each distinct score, counting predictions of at least that score.

    predictions: cls, score, hit (whether it has a true box); truths: cls, positives. envelope is the greatest precision
    at that recall or more. Points are ordered within bins of a class, and counts and maxima carried from bin to bin.
    """
    at = F.least(F.greatest(F.floor((1 - F.col("score")) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    points = predictions.groupBy("cls", "score").agg(F.sum(F.coalesce(F.col("hit"), F.lit(False)).cast("long")).alias("hits"), F.count("*").alias("rows")).withColumn("bin", at)
    bins = points.groupBy("cls", "bin").agg(F.sum("hits").alias("bin_hits"), F.sum("rows").alias("bin_rows"))  # BINS rows a class at most
    before = Window.partitionBy("cls").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("cls", "bin", *[F.coalesce(F.sum(f"bin_{c}").over(before), F.lit(0)).alias(f"{c}_before") for c in ("hits", "rows")])
    inside = Window.partitionBy("cls", "bin").orderBy(F.col("score").desc())
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = points.join(bins, ["cls", "bin"]).join(truths, "cls", "left")
    placed = placed.withColumns({"tp": F.col("hits_before") + F.sum("hits").over(upto), "n": F.col("rows_before") + F.sum("rows").over(upto)})
    placed = placed.withColumns({"precision": F.col("tp") / F.col("n"), "recall": F.coalesce(F.try_divide("tp", "positives"), F.lit(0.0))})
    tops = placed.groupBy("cls", "bin").agg(F.max("precision").alias("top"))
    # in reverse order, as Spark works out a frame to the end anew for each row
    later = F.max("top").over(Window.partitionBy("cls").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1))
    tops = tops.select("cls", "bin", later.alias("later"))
    here = F.max("precision").over(Window.partitionBy("cls", "bin").orderBy("score").rowsBetween(Window.unboundedPreceding, 0))
    out = placed.withColumn("here", here).join(tops, ["cls", "bin"]).withColumn("envelope", F.greatest("here", "later"))
    return out.select("cls", "score", "hits", "tp", "n", "positives", "precision", "recall", "envelope")


def average_precision(points: DataFrame, truths: DataFrame) -> DataFrame:
    """(cls, positives, predicted, tp, precision, recall, ap) of every class with true boxes: precision and recall of all predictions, and the area under the envelope."""
    sums = points.groupBy("cls").agg(F.max("n").alias("predicted"), F.max("tp").alias("tp"), F.sum(F.col("hits") * F.col("envelope")).alias("area"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    both = truths.join(sums, "cls", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("predicted", "tp")})
    return both.select("cls", "positives", "predicted", "tp", zero(F.try_divide("tp", "predicted")).alias("precision"), zero(F.try_divide("tp", "positives")).alias("recall"), zero(F.try_divide("area", "positives")).alias("ap"))


def evaluate(truth: DataFrame, predicted: DataFrame, least: float = 0.5, cell: float = CELL) -> DataFrame:
    """average_precision() of a detector's boxes at an overlap ratio."""
    found = matched(truth, predicted, least, cell).select("cls", F.col("proba").alias("score"), F.col("matched_id").isNotNull().alias("hit"))
    truths = truth.where("x1 < x2 and y1 < y2").groupBy("cls").agg(F.count("*").alias("positives"))
    return average_precision(curve(found, truths), truths)
