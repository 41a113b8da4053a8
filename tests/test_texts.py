"""Overlap and edits of texts against plain versions."""

import collections
import functools
import random
import re

from pyspark.sql import functions as F

from quillspark.operators import error_rates, rouge, summary

PAIRS = [(1, "the cat sat on the mat", "the cat lay on a mat the"), (2, "", "words"), (3, None, None), (4, "one", "one"), (5, "a b a b a", "b a b"), (6, "Ёлка, ёлка!", "ёлка"), (7, "x y z", "z y x"), (8, "!!", "?")]


def plain_tokens(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def f1(hits, p, t):
    a, b = hits / p if p else 0.0, hits / t if t else 0.0
    return a, b, 2 * a * b / (a + b) if a + b else 0.0


def lcs(a, b):
    @functools.cache
    def to(i, j):
        return 0 if i == len(a) or j == len(b) else 1 + to(i + 1, j + 1) if a[i] == b[j] else max(to(i + 1, j), to(i, j + 1))

    return to(0, 0)


def test_rouge(spark):
    r = random.Random(1)
    pairs = PAIRS + [(100 + i, *(" ".join(r.choice("ab cd ef gh ij".split()) for _ in range(r.randint(0, 14))) for _ in "xy")) for i in range(40)]
    df = spark.createDataFrame(pairs, "id long, p string, t string")
    got = {(x.id, x.n): x[2:] for x in rouge.rouge_n(df, ["id"], "p", "t", (1, 2, 3)).collect()}
    longest = {x.id: x[1:] for x in rouge.rouge_l(df, ["id"], "p", "t").collect()}
    assert len(got) == 3 * len(pairs)
    for i, p, t in pairs:
        a, b = plain_tokens(p), plain_tokens(t)
        for n in (1, 2, 3):
            x, y = (collections.Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) for w in (a, b))
            assert all(abs(u - v) < 1e-9 for u, v in zip(got[i, n], f1((x & y).total(), x.total(), y.total()), strict=True))
        assert all(abs(u - v) < 1e-9 for u, v in zip(longest[i], f1(lcs(a, b), len(a), len(b)), strict=True))
    assert {x.measure for x in rouge.means(df, ["id"], "p", "t").collect()} == {"rouge1", "rouge2", "rougeL"} and rouge.rouge_n(df.limit(0), ["id"], "p", "t").count() == 0


def plain_edits(a, b):
    """(edits, substitutions, deletions, insertions): the least by the first two, over all ways."""
    row = [(j, 0, 0, j) for j in range(len(b) + 1)]
    for x in a:
        new = [(row[0][0] + 1, 0, row[0][2] + 1, 0)]
        for j, y in enumerate(b, 1):
            e, s, d, i = row[j - 1]
            keep = (e, s, d, i) if x == y else (e + 1, s + 1, d, i)
            e, s, d, i = row[j]
            u, v, w, z = new[-1]
            new.append(min(keep, (e + 1, s, d + 1, i), (u + 1, v, w, z + 1)))
        row = new
    return row[-1]


def test_edits(spark):
    r = random.Random(2)
    pairs = [("", ""), ("a", ""), ("", "ab"), ("kitten", "sitting"), ("abc", "xyz"), ("ab" * 300, "ba" * 280)] + [tuple("".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in "xy") for _ in range(300)]
    for a, b in pairs:
        e, s, d, i = plain_edits(a, b)
        got = error_rates.edits(a, b)
        assert sum(got) == e and got[0] == s and got[1] - got[2] == len(a) - len(b) and got == (s, d, i)


def test_error_rates(spark):
    rows = [("x", "one two three", "one too three four"), ("x", None, "a"), ("y", "same", "same"), ("z", "", ""), (None, "ab", None), ("x", "one two three", "one too three four")]
    df = spark.createDataFrame(rows, "g string, t string, f string")
    got = {x.g: x for x in error_rates.error_rates(df, ["g"], "t", "f", words=True).collect()}
    assert (got["x"].texts, got["x"]["size"], got["x"].substitutions, got["x"].deletions, got["x"].insertions, got["x"].rate) == (3, 6, 2, 0, 3, 5 / 6)
    assert got["y"].rate == 0 and got["z"].rate is None and got[None].deletions == 1
    plan = error_rates.error_rates(df, ["g"], "t", "f")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan.split("Exchange")[-1]
    assert error_rates.error_rates(df.select(F.lit("g").alias("g"), "t", "f"), ["g"], "t", "f").first()["size"] == sum(len(t or "") for _, t, _ in rows)


def test_summaries(spark):
    rows = [(1, "Common words here. Rare zebra! Common words here? Unusual quagga and okapi.\nLast line"), (2, "Common words here. common."), (3, ""), (4, None), (5, "!!! ..."), (6, "x " * 3000)]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {r.id: r.summary for r in summary.summaries(df, "id", "t", 2).collect()}
    assert got[1] == "Rare zebra! Unusual quagga and okapi." and got[3] is got[4] is None and got[5] == "!!! ..." and got[6] == ("x " * 3000).strip() and len(got) == 6
    assert summary.summaries(df.limit(0), "id", "t").count() == 0


def test_no_sentence_goes_with_its_words(spark):
    df = spark.createDataFrame([(1, "One two. Three four.")], "id long, t string")
    plan = summary.summaries(df, "id", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "first(sentence" not in plan and summary.summaries(df, "id", "t", 1).first().summary == "One two."


def test_summaries_of_the_rows_asked_for_weigh_words_by_all_texts(spark):
    rows = [(i, f"One of {i % 3} words. Told {i}: rare word{i}! One of words.") for i in range(12)]
    df = spark.createDataFrame(rows, "id long, t string")
    some, every = summary.summaries(df, "id", "t", 1, F.col("id") % 5 == 0), summary.summaries(df, "id", "t", 1).where("id % 5 = 0")
    assert sorted(some.collect()) == sorted(every.collect()) and some.count() == 3


def test_grams_are_counted_in_their_row(spark):
    rows = [(1, "a b a b", "a b b a b c"), (2, "", "x"), (3, None, None), (4, "x", "x"), (5, "A-b a", "a b")]
    df = spark.createDataFrame(rows, "id long, p string, t string")
    out = rouge.rouge_n(df, ["id"], "p", "t")
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.id, r.n): (r.precision, r.recall) for r in out.collect()}
    assert got[1, 1] == (1.0, 4 / 6) and got[1, 2] == (1.0, 3 / 5) and got[2, 1] == got[3, 2] == got[4, 2] == (0.0, 0.0) and got[4, 1] == (1.0, 1.0)
    assert got[5, 1] == (2 / 3, 1.0) and got[5, 2] == (0.5, 1.0) and len(got) == 10


def test_numeric_dates_are_as_in_sql(spark, tmp_path):
    """Any white space before a date, months' names and digits of other scripts are not in what the SQL finds."""
    from quillspark.plans import queries

    texts = ["a\n\t12.03.2024", "5 мая 2020", "٣.04.2024", "  1.02.24 g", None, "x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.found for r in queries.date_extract(spark, str(tmp_path)).collect()} == {0: "12.03.2024", 1: None, 2: None, 3: "1.02.24", 4: None, 5: None}
