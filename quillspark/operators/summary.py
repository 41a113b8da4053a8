"""Summaries of the most telling sentences, and search by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators import encoder, search
from quillspark.sources.durable import kept

#: Sentences of a summary.
SENTENCES = 3


def sentences(text: Column) -> Column:
    """Pieces of a text that end with a point, a question or an exclamation mark before white space, or with a line; blank ones are none."""
    cut = F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+|\n+")
    return F.filter(F.transform(cut, lambda s: F.trim(s)), lambda s: s != "")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def summaries(df: DataFrame, key: str, text: str, n: int = SENTENCES, asked: Column | None = None) -> DataFrame:
    """(key, summary): of each text its n best sentences in their order, joined by spaces; null without a sentence. key is unique.

    A sentence is worth the mean of its distinct words' weights, ln of the number of texts over that of texts with the
    word, to six digits; of equal ones the first is better. Words are counted over all texts; a long text is many rows. With
    `asked` only the rows for which it holds have a summary.
    """
    of = df if asked is None else df.where(asked)
    cut = of.select(key, F.posexplode(sentences(F.col(text))).alias("place", "sentence"))
    told = cut.select(key, "place", F.explode_outer(F.array_distinct(words(F.col("sentence")))).alias("word"))
    own = F.array_distinct(F.flatten(F.transform(sentences(F.col(text)), words)))  # of each text once, so a task sums up before the shuffle
    held = df.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("texts"))
    total = df.agg(F.count("*").alias("total"))
    weight = F.log(F.col("total").cast("double") / F.col("texts"))
    known = held.join(F.broadcast(total)).select("word", weight.alias("weight"))
    worth = told.join(known, "word", "left").groupBy(key, "place").agg(F.round(F.avg(F.coalesce("weight", F.lit(0.0))), 6).alias("worth"))
    best = worth.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.col("worth").desc(), "place"))).where(F.col("rank") <= n)
    places = best.groupBy(key).agg(F.array_sort(F.collect_list("place")).alias("places"))  # n at most
    chosen = of.select(key, text).join(places, key)  # texts are cut again, so that no sentence goes with each of its words
    made = chosen.select(key, F.array_join(F.get(F.transform(F.array(sentences(F.col(text))), lambda s: F.transform("places", lambda p: F.get(s, p))), F.lit(0)), " ").alias("summary"))
    return of.select(key).join(made, key, "left")


def search_by_summary(df: DataFrame, key: str, text: str, asked: Column, k: int) -> DataFrame:
    """(query_id, id, cos, place): the k texts whose vectors are nearest to that of the summary of each row asked for, itself left out."""
    # both are counted and read, so they are kept
    vectors = kept(encoder.encoded(df, key, text).select(key, "vector"))
    queries = kept(encoder.encoded(kept(summaries(df, key, text, asked=asked)), key, "summary").select(key, "vector"))
    return search.nearest(vectors, queries, key, "vector", k)
