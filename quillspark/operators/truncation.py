"""What a limit on tokens costs: texts cut into the longest known pieces, and what is left of them at each limit."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces of a vocabulary at most, each of at most so many characters; it is sent to every task.
PIECES, LONGEST = 50_000, 16
MARK = "▁"


class Trie:
    """Known pieces as a tree of characters; single characters are always known."""

    def __init__(self, pieces: Iterable[str]):
        self.root: dict = {}
        for piece in pieces:
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = True  # a piece ends here

    def cut(self, word: str) -> list[int]:
        """Lengths of the pieces of a word, each the longest known one from where the one before ends."""
        out, at = [], 0
        while at < len(word):
            node, best, i = self.root, 1, at
            while i < len(word) and (node := node.get(word[i])) is not None:
                i += 1
                if "" in node:
                    best = i - at
            out.append(best)
            at += best
        return out


def vocabulary(df: DataFrame, text: str, pieces: int = PIECES) -> list[str]:
    """The most frequent beginnings and rests of words, by their number of occurrences, then by themselves; words are marked at their start. `pieces` of them at most."""
    words = df.select(F.explode(F.split(F.coalesce(text, F.lit("")), r"\s+")).alias("w")).where("w <> ''").groupBy("w").agg(F.count("*").alias("n"))
    marked = words.select(F.concat(F.lit(MARK), "w").alias("w"), "n")
    size = F.least(F.length("w"), F.lit(LONGEST))
    heads = F.transform(F.sequence(F.lit(2), size), lambda k: F.substring(F.col("w"), F.lit(1), k))
    tails = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.substring(F.col("w"), F.length("w") - k + 1, k))
    counted = marked.select(F.explode(F.concat(heads, tails)).alias("piece"), "n").groupBy("piece").agg(F.sum("n").alias("n")).where("length(piece) > 1")
    return [r.piece for r in counted.orderBy(F.col("n").desc(), "piece").limit(pieces).collect()]  # PIECES at most


def study(df: DataFrame, key: str, text: str, pieces: list[str], limits: list[int]) -> DataFrame:
    """(key, num_symbols, num_words, num_tokens, limit, kept_symbols, kept_words, kept_tokens) of each text and limit.

    A text is cut once, word by word, equal words of a task once; running counts of tokens give all limits. A word whose
    tokens pass the limit is kept in part: it counts for its symbols, not as a word. Symbols between words count with the word before.
    """
    if len(pieces) > PIECES:
        raise ValueError(f"a vocabulary has {PIECES} pieces at most")
    limits = sorted(limits)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, known = Trie(pieces), {}
        for batch in batches:
            out = []
            for name, whole in zip(batch["key"], batch["text"], strict=True):
                whole = whole or ""
                words = whole.split()
                at, seen, done, ends = 0, 0, 0, iter(limits)
                limit, rows = next(ends, None), []
                for number, word in enumerate(words):
                    start = whole.index(word, at)
                    if word not in known:
                        if len(known) > 200_000:
                            known.clear()
                        known[word] = trie.cut(MARK + word)
                    sizes = known[word]
                    while limit is not None and seen + len(sizes) > limit:
                        inside = sum(sizes[: limit - seen]) - 1 if limit > seen else 0  # without the mark
                        rows.append((limit, start + inside if inside > 0 else at, done, limit))
                        limit = next(ends, None)
                    seen, at, done = seen + len(sizes), start + len(word), number + 1
                while limit is not None:
                    rows.append((limit, len(whole), len(words), seen))
                    limit = next(ends, None)
                out += [(name, len(whole), len(words), seen, *r) for r in rows]
            yield pd.DataFrame(out, columns=["key", "num_symbols", "num_words", "num_tokens", "limit", "kept_symbols", "kept_words", "kept_tokens"])

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, num_symbols bigint, num_words bigint, num_tokens bigint, `limit` int, kept_symbols bigint, kept_words bigint, kept_tokens bigint"
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(cut, schema).withColumnRenamed("key", key)


def kept_shares(rows: DataFrame) -> DataFrame:
    """(limit, texts, whole, symbols, words, tokens) of study(): the share of texts that a limit leaves whole, and of all symbols, words and tokens."""
    share = lambda c: F.try_divide(F.sum(f"kept_{c}").cast("double"), F.sum(f"num_{c}").cast("double")).alias(c)
    whole = F.avg((F.col("num_tokens") <= F.col("limit")).cast("double"))
    return rows.groupBy("limit").agg(F.count("*").alias("texts"), whole.alias("whole"), *[share(c) for c in ("symbols", "words", "tokens")])
