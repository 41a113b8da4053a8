"""The encoder column against its plain version; the truncation study against a plain loop."""

import collections
import random

import numpy as np
from pyspark.sql import functions as F

from quillspark.operators import encoder, truncation

TEXTS = [(1, "one two three"), (2, ""), (3, None), (4, "word " * 200), (5, "other words " * 40), (6, "!!! ..."), (7, "Ёлка und été")]


def test_encoder(spark):
    df = spark.createDataFrame(TEXTS, "id long, text string")
    ids = {r.id: list(r.ids) for r in df.select("id", encoder.token_ids(F.col("text")).alias("ids")).collect()}
    got = {r.id: r for r in encoder.encoded(df, "id", "text", size=16, batch=8).collect()}
    net = encoder.Network()
    assert len(got) == len(TEXTS)
    for i, words in ids.items():
        cuts = [words[k : k + 16] for k in range(0, len(words), 16)]
        assert got[i].n_windows == len(cuts)
        if not cuts:
            assert got[i].vector is None
            continue
        v = net(np.array([c + [0] * (16 - len(c)) for c in cuts]))
        want = (v * np.array([len(c) for c in cuts])[:, None]).sum(0)
        assert np.allclose(got[i].vector, want / np.linalg.norm(want), atol=1e-9)
    assert encoder.encoded(df.limit(0), "id", "text").count() == 0


def test_batches(spark):
    """The model is loaded once a worker and sees no more than a batch."""

    class Counting:
        """A model that says how many windows it saw at once, and which of its kind it is."""

        made = 0

        def __init__(self):
            Counting.made += 1
            self.number = Counting.made

        def __call__(self, windows):
            return np.array([[float(len(windows)), float(self.number), float((w > 0).sum())] for w in windows])

    df = spark.range(100, numPartitions=2).select(F.array(*[F.lit(1)] * 4).alias("w"))
    rows = [r.v for r in df.select(encoder.encoder(Counting, 4, 16)(F.col("w")).alias("v")).collect()]
    assert len(rows) == 100 and max(r[0] for r in rows) == 16 and {r[2] for r in rows} == {4.0} and {r[1] for r in rows} == {1.0}


def plain_study(text, pieces, limit):
    """Tokens one by one, with the symbol and word at which each ends."""
    text = text or ""
    ends, at, done = [], 0, 0
    for word in text.split():
        start = text.index(word, at)
        marked, k = truncation.MARK + word, 0
        while k < len(marked):
            size = max([n for n in range(1, truncation.LONGEST + 1) if marked[k : k + n] in pieces and k + n <= len(marked)], default=1)
            k += size
            ends.append((start + k - 1 if k > 1 else at, done + (k == len(marked))))
        at, done = start + len(word), done + 1
    if len(ends) <= limit:
        return len(text), len(text.split()), len(ends)
    return (*ends[limit - 1], limit) if limit else (0, 0, 0)


def test_truncation(spark):
    r = random.Random(4)
    texts = [*TEXTS, *((100 + i, " ".join("".join(r.choice("abcd") for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 40))) + "  \n x") for i in range(30))]
    df = spark.createDataFrame(texts, "id long, text string")
    pieces = truncation.vocabulary(df, "text", 60)
    assert len(pieces) == len(set(pieces)) == 60 and all(1 < len(p) <= truncation.LONGEST for p in pieces)
    counts = collections.Counter(t[: k + 1] for _, text in texts for t in [truncation.MARK + w for w in (text or "").split()] for k in range(1, min(len(t), truncation.LONGEST)))
    assert counts[next(p for p in pieces if p.startswith(truncation.MARK))] >= counts[f"{truncation.MARK}words"]
    rows = truncation.study(df, "id", "text", pieces, [0, 3, 10, 1000])
    got = {(x.id, x["limit"]): (x.kept_symbols, x.kept_words, x.kept_tokens) for x in rows.collect()}
    assert len(got) == 4 * len(texts)
    for i, text in texts:
        for limit in (0, 3, 10, 1000):
            assert got[i, limit] == plain_study(text, set(pieces), limit), (i, limit)
    shares = {x["limit"]: x for x in truncation.kept_shares(rows).collect()}
    assert shares[1000].whole == shares[1000].tokens == shares[1000].symbols == 1.0 and shares[0].tokens == 0 and shares[3].texts == len(texts)


def test_trie():
    trie = truncation.Trie(["ab", "abcd", "c", "bcde"])
    assert trie.cut("abcde") == [4, 1] and trie.cut("abce") == [2, 1, 1] and trie.cut("xbcde") == [1, 4] and trie.cut("") == []


def test_forest_works_out_few_rows_and_those_once(spark):
    from pyspark.sql import functions as F

    from quillspark.operators import block_model

    made = spark.sparkContext.accumulator(0)

    def value(i):
        made.add(1)
        return float(i % 7)

    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.udf(value, "double")("id").alias("f"), F.when(F.col("id") % 7 == 3, "a").otherwise("other").alias("target"))
    for most, times in ((10_000, 1.1), (400, 0.4)):
        made.value = 0
        model = block_model.fit(rows, "a", ("f",), trees=3, most=most)
        assert 0 < made.value <= times * 4000, made.value
        told = block_model.scored(rows.where("doc_id < 70"), model, ("f",))
        assert told.where("(proba > 0.5) <> (target = 'a')").count() == 0


def test_forest_learns_from_all_rows(spark):
    """What only the documents of the last hashes have is learned, too, however many there are."""
    from quillspark.operators import block_model

    rows = spark.range(200_500).select(F.col("id").alias("doc_id"), F.pmod(F.xxhash64("id"), F.lit(1 << 20)).alias("place"))
    last = [r.doc_id for r in rows.orderBy(F.col("place").desc()).limit(300).collect()]
    rows = rows.select("doc_id", F.col("doc_id").isin(last).cast("double").alias("f")).withColumn("target", F.when(F.col("f") == 1, "a").otherwise("other"))
    model = block_model.fit(rows, "a", ("f",), trees=3)
    told = block_model.scored(rows, model, ("f",)).groupBy("f").agg(F.min("proba").alias("low"), F.max("proba").alias("high"))
    assert {r.f: (r.low, r.high) for r in told.collect()} == {0.0: (0.0, 0.0), 1.0: (1.0, 1.0)}
