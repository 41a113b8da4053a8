"""Source divergence audit: how far the words of each source are from those of the other sources and of its language.

1. One pass over the texts counts, per slice, the terms of each language and source, and the rows that hold them, by
   integer codes. The counts of slices are summed by shuffle.
2. The counts are sorted by language and term and dealt to ranges. A range is an array of kept terms, and the place of a
   term in it (searchsorted) is its id; ids are in the order of UTF-8. Each range is stored with its ids and counts.
3. Each range becomes a dense matrix of sources by ids, from which shares and distances follow for all pairs of sources;
   sums over ranges give the pairs, the best terms of ranges the best of all.

All arithmetic is on 64-bit integers and exact for up to 9 * 10^15 occurrences of kept terms and twice as many kept terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import coded_terms, discard, letters_table, released, sliced, stored

LETTERS = letters_table(digits=False)
#: A term is kept in a language if at least so many of its documents hold it.
LEAST_DOCS = 10
TOP_TERMS = 10
#: Bytes of text that are counted together.
SLICE = 4 << 20
#: Rows of a range: at least and at most. Between them their number grows with the square of the sources, so that the sums of pairs do not outnumber the counts.
RANGE_ROWS, MOST_RANGE_ROWS = 20_000, 2_000_000
#: Cells of a dense matrix.
CELLS = 1 << 20
#: A language's sources are sent to its ranges in so many copies, so that ranges of one language are not one key.
COPIES = 32
ENCODED = "chunk int, lang string, terms array<string>, sources array<string>, at array<int>, id array<int>, n array<long>, totals array<long>"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n, docs of each slice."""
    for batch in sliced(batches, limit=SLICE):
        groups, group = {}, np.zeros(batch.num_rows, np.int64)
        for i, pair in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)):
            group[i] = groups.setdefault(pair, len(groups))
        terms, code, text = coded_terms(batch.column("text"), LETTERS)
        size = max(len(terms), 1)
        cell, n = np.unique(group[text] * size + code, return_counts=True)
        held = np.unique(text * size + code)  # once for each text and term
        docs = np.bincount(np.searchsorted(cell, group[held // size] * size + held % size), minlength=len(cell)).astype(np.int64)
        names = list(groups)
        lang, source = (pa.array([pair[k] for pair in names], pa.string()).take(pa.array(cell // size)) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([lang, source, terms.take(pa.array(cell % size)).cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(docs)], names=["lang", "source", "term", "n", "docs"])


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Where a sorted column has another value than in the row before; the first row counts."""
    out = np.ones(len(column), bool)
    if len(column) > 1:
        out[1:] = pc.not_equal(column[1:], column[:-1]).to_numpy()
    return out


def _encoder(least: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The kept terms of a range, sorted, and of each row that has one its source's and its term's place."""
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId()
        batches = list(batches)  # a range, RANGE_ROWS to MOST_RANGE_ROWS on average
        if not sum(b.num_rows for b in batches):
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        langs = np.flatnonzero(_changes(rows["lang"]))
        for begin, end in zip(langs, np.append(langs[1:], rows.num_rows), strict=True):
            part = rows.slice(begin, end - begin).combine_chunks()
            first = _changes(part["term"])
            term = np.cumsum(first) - 1
            docs = np.add.reduceat(part["docs"].to_numpy(), np.flatnonzero(first))
            kept = np.flatnonzero(docs >= least)
            row = np.flatnonzero((docs >= least)[term])
            ids = np.searchsorted(kept, term[row])
            of = part["source"].combine_chunks().dictionary_encode()
            of = of.combine_chunks() if isinstance(of, pa.ChunkedArray) else of
            at, n = of.indices.to_numpy()[row], part["n"].to_numpy()[row]
            totals = np.zeros(len(of.dictionary), np.int64)
            np.add.at(totals, at, n)
            names = part["term"].take(pa.array(np.flatnonzero(first)[kept]))
            one = lambda x, kind: pa.array([x], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int32()), part["lang"].slice(0, 1).combine_chunks(), one(names.to_pylist(), pa.string()), one(of.dictionary.to_pylist(), pa.string()),
                    one(at.astype(np.int32), pa.int32()), one(ids.astype(np.int32), pa.int32()), one(n, pa.int64()), one(totals, pa.int64()),
                ],
                names=["chunk", "lang", "terms", "sources", "at", "id", "n", "totals"],
            )

    return encoded


def shares(counts: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(10^9 (counts + 2) / (total + 2 kept)), three digits at a time, so that nothing is over 64 bits."""
    below = np.asarray(total, np.int64) + 2 * kept
    rest = np.asarray(counts, np.int64) + 2
    out = rest // below
    rest = rest - out * below
    for _ in range(3):
        rest = rest * 1000
        digit = rest // below
        out, rest = out * 1000 + digit, rest - digit * below
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: distances of all pairs of the language's sources (the first sorts before the second), and the best terms of each source."""
    for batch in batches:
        for row in range(batch.num_rows):
            col = {name: batch.column(name)[row] for name in batch.schema.names}
            lang, names, kept = col["lang"].as_py(), col["every"].as_py(), col["kept"].as_py()
            totals = col["total"].values.to_numpy().astype(np.int64)
            place = {s: i for i, s in enumerate(names)}
            own = np.array([place[s] for s in col["sources"].as_py()], np.int64)
            at, ids, n = own[col["at"].values.to_numpy()], col["id"].values.to_numpy(), col["n"].values.to_numpy()
            terms, many = col["terms"].values, len(names)
            sums = np.zeros((many, many), np.int64)
            best: list[list[tuple[int, int]]] = [[] for _ in names]
            width = max(1, CELLS // many)
            order = np.argsort(ids, kind="stable")
            at, ids, n = at[order], ids[order], n[order]
            for low in range(0, len(terms), width):
                high = min(len(terms), low + width)
                here = slice(*np.searchsorted(ids, (low, high)))
                counts = np.zeros((many, high - low), np.int64)
                counts[at[here], ids[here] - low] = n[here]
                p = shares(counts, totals[:, None], kept)
                q = shares(counts.sum(0), totals.sum(), kept)
                for a in range(many - 1):
                    sums[a, a + 1 :] += apart(p[a], p[a + 1 :]).sum(1)
                value = np.where((counts > 0) & (p > q), apart(p, q), -1)
                for a in range(many):
                    first = np.argsort(-value[a], kind="stable")[:TOP_TERMS]  # equal values: smaller ids first
                    best[a] += [(int(value[a, i]), low + int(i)) for i in first if value[a, i] >= 0]
                    best[a] = sorted(best[a], key=lambda x: (-x[0], x[1]))[:TOP_TERMS]
            a, b = np.triu_indices(many, 1)
            every, found = pa.array(names, pa.string()), [(a, v, i) for a in range(many) for v, i in best[a]]
            for part, source, item, value in (
                ("pair", every.take(pa.array(a)), every.take(pa.array(b)), sums[a, b]),
                ("term", every.take(pa.array([x[0] for x in found], pa.int64())), terms.take(pa.array([x[2] for x in found], pa.int64())), np.array([x[1] for x in found], np.int64)),
            ):
                if len(value):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(value), pa.string()), source, pa.array([part] * len(value)), item.cast(pa.string()), pa.array(value)], names=["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: of each source of a language its distances from the other
    sources, and up to ten terms that it has more often than the language.

    Null texts, langs and sources count as empty ones. Each row is a document, repeated rows too. Groups without terms
    have pairs; a language's only source has none; a language without kept terms has pairs of value 0 and no terms. Equal
    values are ranked by item, as UTF-8. Other columns are not read. An empty table gives no rows.
    """
    named = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    rows = docs.select(*named, docs["text"].cast("string").alias("text"))
    partial = rows.mapInArrow(lambda batches: released(_counted(batches)), "lang string, source string, term string, n long, docs long")
    counts = stored(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    groups = stored(docs.select(*named).distinct())
    n_rows, most = counts.count(), groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    per_range = min(max(RANGE_ROWS, most * most), MOST_RANGE_ROWS)
    dealt = counts.repartitionByRange(max(1, math.ceil(n_rows / per_range)), "lang", "term").sortWithinPartitions("lang", "term")
    encoded = stored(dealt.mapInArrow(_encoder(least), ENCODED))
    sums = encoded.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("s")).groupBy("lang", F.col("s.sources").alias("source")).agg(F.sum("s.totals").alias("total"))
    kept = encoded.groupBy("lang").agg(F.sum(F.size("terms")).alias("kept"))
    known = groups.join(sums, ["lang", "source"], "left").select("lang", F.struct("source", F.coalesce("total", F.lit(0)).alias("total")).alias("s"))
    langs = known.groupBy("lang").agg(F.array_sort(F.collect_list("s")).alias("s")).join(kept, "lang", "left")  # the sources of a language; all pairs of them are the result
    langs = stored(langs.select("lang", F.col("s.source").alias("every"), F.col("s.total").alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")))
    copies = langs.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    met = encoded.where(F.size("terms") > 0).withColumn("copy", F.pmod("chunk", F.lit(COPIES))).join(copies, ["lang", "copy"])
    scored = stored(met.mapInArrow(lambda batches: released(_scored(batches)), "lang string, source string, part string, item string, value long"))
    empty = langs.where("kept = 0").select("lang", F.explode("every").alias("source"), "every").select("lang", "source", F.explode("every").alias("item")).where("source < item")
    half = scored.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(empty.withColumn("value", F.lit(0).cast("bigint")))
    sides = F.explode(F.array(F.struct(F.col("source"), F.col("item")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = half.select("lang", sides.alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    both = pairs.unionByName(scored.where("part = 'term'"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    out = stored(both.withColumn("rank", place).where(f"part = 'pair' or rank <= {TOP_TERMS}").select("lang", "source", "part", "item", "value", "rank"))
    discard(counts, groups, encoded, langs, scored)
    return out


def audit_sql() -> str:
    """The same in DuckDB SQL over the view documents."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = "(1 + (1000000000::HUGEINT * (c + 2)) // (total + 2 * v))"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}') AS text FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    t AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= {LEAST_DOCS}),
    v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
    n AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
    f AS (SELECT lang, source, term, coalesce(c, 0) AS c FROM g JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)),
    p AS (SELECT lang, source, term, c, {share} AS p FROM (SELECT *, sum(c) OVER (PARTITION BY lang, source) AS total FROM f) JOIN v USING (lang)),
    q AS (SELECT lang, term, {share} AS q FROM (SELECT *, sum(c) OVER (PARTITION BY lang) AS total FROM (SELECT lang, term, sum(c) AS c FROM f GROUP BY lang, term)) JOIN v USING (lang)),
    pairs AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
    apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    every AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN apart USING (lang, source, item)
        UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every) WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
