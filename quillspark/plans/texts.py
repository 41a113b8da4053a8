"""Queries that hold texts against texts: overlap of turns, edits and error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import error_rates as E
from quillspark.operators import encoder, rouge, summary, truncation
from quillspark.plans.queries import query
from quillspark.sources.readers import table

TURNS = "SELECT a.conv_id, a.turn, a.text AS predicted, b.text AS truth FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1"
WORDS = "list_filter(string_split_regex(lower(coalesce({}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn of a conversation with the next one, as predicted and true text."""
    c = table(spark, sf, "conversations")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("truth"))
    return c.select("conv_id", "turn", F.col("text").alias("predicted")).join(after, ["conv_id", "turn"])


def _gram_sql(n: int) -> str:
    """Counts of the n-grams of both sides of each pair of turns."""
    return f"""SELECT conv_id, turn, {n} AS n, gram, count(*) FILTER (side = 0) AS p, count(*) FILTER (side = 1) AS t FROM (
        SELECT conv_id, turn, side, unnest(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i : i + {n} - 1], ' '))) AS gram FROM w) GROUP BY ALL"""


@query(f"""WITH p AS ({TURNS}), w AS (SELECT conv_id, turn, 0 AS side, {WORDS.format('predicted')} AS w FROM p UNION ALL SELECT conv_id, turn, 1, {WORDS.format('truth')} FROM p), g AS ({_gram_sql(1)} UNION ALL {_gram_sql(2)}),
    s AS (SELECT conv_id, turn, n, sum(least(p, t)) AS hits, sum(p) AS np, sum(t) AS nt FROM g GROUP BY ALL), e AS (SELECT conv_id, turn, unnest([1, 2]) AS n FROM p),
    r AS (SELECT conv_id, turn, n, coalesce(hits / nullif(np, 0)::DOUBLE, 0) AS p, coalesce(hits / nullif(nt, 0)::DOUBLE, 0) AS r FROM e LEFT JOIN s USING (conv_id, turn, n))
    SELECT conv_id, turn, n, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM r""")
def rouge_n(spark, sf):
    """Words and pairs of words that a turn shares with the next one."""
    return rouge.rouge_n(_turns(spark, sf), ["conv_id", "turn"], "predicted", "truth").select("conv_id", "turn", "n", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query()
def rouge_means(spark, sf):
    """Means of all three measures over the turns."""
    return rouge.means(_turns(spark, sf), ["conv_id", "turn"], "predicted", "truth")


@query("""SELECT p_brand, count(*) AS texts, sum(length(p_name)) ::BIGINT AS size, sum(levenshtein(p_name, lower(p_type) || ' ' || p_name[1:-2]))::BIGINT AS edits, round(sum(levenshtein(p_name, lower(p_type) || ' ' || p_name[1:-2])) / sum(length(p_name)), 6) AS rate FROM part GROUP BY p_brand""")
def character_error_rates(spark, sf):
    """Edits of the characters of names that a reader has found behind their type and without the last letter, by brand."""
    p = table(spark, sf, "part").select("p_brand", "p_name", F.concat(F.lower("p_type"), F.lit(" "), F.expr("substring(p_name, 1, length(p_name) - 1)")).alias("found"))
    out = E.error_rates(p, ["p_brand"], "p_name", "found")
    return out.select("p_brand", "texts", "size", (F.col("substitutions") + F.col("deletions") + F.col("insertions")).alias("edits"), F.round("rate", 6).alias("rate"))


@query()
def word_error_rates(spark, sf):
    """Edits of words from each turn to the next, by the role that speaks."""
    roles = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return E.error_rates(_turns(spark, sf).join(roles, ["conv_id", "turn"]), ["role"], "truth", "predicted", words=True)


@query()
def encoded_documents(spark, sf):
    """Each whole document as a vector of the encoder, by windows."""
    out = encoder.encoded(table(spark, sf, "documents"), "doc_id", "text")
    return out.select("doc_id", "n_windows", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


LIMITS = [64, 128, 256, 512, 1024]


@query()
def truncation_study(spark, sf):
    """What limits on tokens leave of the documents, with a vocabulary of their own words' pieces."""
    docs = table(spark, sf, "documents")
    rows = truncation.study(docs, "doc_id", "text", truncation.vocabulary(docs, "text", 5000), LIMITS)
    return truncation.kept_shares(rows)


SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+|\n+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""WITH s AS (SELECT doc_id, unnest(p) AS sentence, generate_subscripts(p, 1) AS place FROM (SELECT doc_id, {SENTENCES} AS p FROM documents)), w AS (SELECT doc_id, place, sentence, unnest(CASE WHEN len(u) = 0 THEN [NULL] ELSE u END) AS word FROM (SELECT *, list_distinct({WORDS.format('sentence')}) AS u FROM s)),
    h AS (SELECT word, ln((SELECT count(*) FROM documents)::DOUBLE / count(DISTINCT doc_id)) AS weight FROM w WHERE word IS NOT NULL GROUP BY word), v AS (SELECT doc_id, place, any_value(sentence) AS sentence, round(avg(coalesce(weight, 0)), 6) AS worth FROM w LEFT JOIN h USING (word) GROUP BY doc_id, place),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY worth DESC, place) AS k FROM v) SELECT doc_id, md5(coalesce(string_agg(sentence, ' ' ORDER BY place), '')) AS digest FROM documents LEFT JOIN r USING (doc_id) WHERE k <= 3 OR k IS NULL GROUP BY doc_id""")
def summaries(spark, sf):
    """The three most telling sentences of each document."""
    out = summary.summaries(table(spark, sf, "documents"), "doc_id", "text")
    return out.select("doc_id", F.md5(F.coalesce("summary", F.lit(""))).alias("digest"))


@query()
def search_by_summary(spark, sf):
    """Documents nearest to the summary of every 50th."""
    return summary.search_by_summary(table(spark, sf, "documents"), "doc_id", "text", F.col("doc_id") % 50 == 0, 5)
