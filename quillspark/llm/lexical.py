"""Ranked lexical search: an index of segments with compressed posting blocks, searched by Block-Max WAND.

Index. A first pass counts documents and terms. A second one cuts the documents of each task into segments of about
SEGMENT bytes of text, in the order of doc_id. A segment's term has its postings in blocks of BLOCK documents: gaps and
counts in as few bytes as the block's largest needs, and in the open the first and last document and the largest impact.
Both passes are without shuffle, and every document is indexed.

Search. Terms of the items are joined with the postings of every segment, and each segment meets a block of items in one
task. For an item all pointers move shallowly at once: where blocks begin and end, the sum of the largest impacts of the
blocks there changes, and documents below the threshold are passed over. Of the others those of largest bound are scored
first, which raises the threshold. Then, as at WAND's pivot, only blocks of lists that can lift a document over the
threshold are decoded; documents that still can reach it have the rest of their blocks decoded. A part of the segments
is searched before the others, whose first threshold is the score that an item's last hit has there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import coded_terms, discard, letters_table, released, sliced, stored, text_bytes

LETTERS = letters_table(digits=True)
#: Documents of a posting block; bytes of text of a segment.
BLOCK, SEGMENT = 128, 8 << 20
#: Items that meet a segment together, on average.
ITEMS = 256
TOP = 20
#: One segment in so many is searched first.
FIRST = 8
#: Documents of largest bound that are scored first.
HEAD = 256
#: Impacts are 10^9 tf / (1000 tf + 12 m), where m goes from 100 - SLOPE with the length of the document.
SCALE, DAMP, SLOPE = 1_000_000_000, 12, 25
EXACT = 1 << 53  # whole numbers below this are exact in doubles
INDEX = "segment string, term string, df long, first array<int>, last array<int>, top array<long>, widths array<int>, payload binary, ids array<long>, m array<long>"
FOUND = "key string, doc_id long, score long"


@dataclass
class Index:
    """Stored postings, one row a segment and term, and one a segment (term null) with its doc_ids and lengths."""

    rows: DataFrame
    docs: int
    terms: int


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a term, terms and bytes of a task."""
    sums = np.zeros(3, np.int64)
    for batch in sliced(batches):
        offsets, data = text_bytes(batch.column("text"))
        inside = LETTERS[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = offsets[(offsets > 0) & (offsets < len(inside))]
        first[edges] = inside[edges]
        before = np.concatenate([[0], np.cumsum(first)])[offsets]
        sums += (int((np.diff(before) > 0).sum()), int(before[-1]), len(data))
    yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in sums], names=["docs", "terms", "bytes"])


def lengths(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """100 - 25 + (25 n docs) div terms."""
    if len(n) and int(n.max()) * SLOPE * docs >= 1 << 63:
        return np.array([100 - SLOPE + SLOPE * int(x) * docs // terms for x in n], np.int64)
    return 100 - SLOPE + SLOPE * n * docs // terms


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SCALE * tf // (1000 * tf + DAMP * m)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... of each pair."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def widths(most: np.ndarray) -> np.ndarray:
    """Bytes for values up to most: 0, 1, 2 or 4."""
    return np.select([most == 0, most < 1 << 8, most < 1 << 16], [0, 1, 2], 4)


def packed(gap: np.ndarray, tf: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all blocks one after the other, and the bytes a gap and a count take in each block."""
    wide = [widths(np.maximum.reduceat(x, start)) for x in (gap, tf - 1)] if len(start) else [np.zeros(0, np.int64)] * 2
    at = np.cumsum(count * (wide[0] + wide[1])) - count * (wide[0] + wide[1])
    out = np.zeros(int((count * (wide[0] + wide[1])).sum()), np.uint8)
    block = np.repeat(np.arange(len(start)), count)
    place = np.arange(len(gap)) - np.repeat(start, count)
    for x, w, base in ((gap, wide[0], at), (tf - 1, wide[1], at + count * wide[0])):
        for k in range(4):
            on = np.flatnonzero(w[block] > k)
            out[base[block[on]] + place[on] * w[block[on]] + k] = (x[on] >> (8 * k)) & 255
    return out, wide[0], wide[1]


def unpacked(data: np.ndarray, at: np.ndarray, count: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """The values of fields that begin at `at` and have `count` values of `wide` bytes."""
    w, place = np.repeat(wide, count), ranges(np.zeros(len(count), np.int64), count)
    base, out = np.repeat(at, count) + place * w, np.zeros(len(w), np.int64)
    for k in range(int(wide.max()) if len(wide) else 0):
        on = np.flatnonzero(w > k)
        out[on] |= data[base[on] + k].astype(np.int64) << (8 * k)
    return out


def _segment(name: str, parts: list[pa.RecordBatch], docs: int, terms: int) -> Iterator[pa.RecordBatch]:
    """The rows of a segment."""
    table = pa.Table.from_batches(parts).combine_chunks()
    order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending")], null_placement="at_end").to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    texts = table["text"].combine_chunks()
    known, code, of = coded_terms(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, LETTERS)
    doc, size = rank[of], len(order)
    m = lengths(np.bincount(doc, minlength=size), docs, terms)
    cell, tf = np.unique(code.astype(np.int64) * size + doc, return_counts=True)
    code, doc = cell // size, cell % size
    df = np.bincount(code, minlength=len(known))
    begin = np.cumsum(df) - df
    blocks = -(-df // BLOCK)
    start = np.repeat(begin, blocks) + BLOCK * ranges(np.zeros(len(blocks), np.int64), blocks)
    end = np.minimum(start + BLOCK, np.repeat(begin + df, blocks))
    gap = np.diff(doc, prepend=0)
    gap[start] = 0
    payload, w_gap, w_tf = packed(gap, tf, start, end - start)
    nbytes = (end - start) * (w_gap + w_tf)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    cut = np.concatenate([[0], np.cumsum(nbytes)])[first_block]
    lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(first_block, pa.int32()), pa.array(x, kind))
    top = np.maximum.reduceat(impacts(tf, m[doc]), start) if len(start) else np.zeros(0, np.int64)
    null = lambda n, kind: pa.nulls(n, kind)
    names = ["segment", "term", "df", "first", "last", "top", "widths", "payload", "ids", "m"]
    n = len(known)
    ids = table["doc_id"].combine_chunks().take(pa.array(order))
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), x)
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    yield pa.RecordBatch.from_arrays([
        pa.array([name]), null(1, pa.string()), null(1, pa.int64()), null(1, ints), null(1, ints), null(1, longs), null(1, ints), null(1, pa.binary()),
        one(ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids), one(pa.array(m)),
    ], names=names)
    made = pa.RecordBatch.from_arrays([
        pa.array([name] * n, pa.string()), known.cast(pa.string()), pa.array(df), lists(doc[start], pa.int32()), lists(doc[end - 1], pa.int32()), lists(top, pa.int64()),
        lists(w_gap * 8 + w_tf, pa.int32()), pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(payload)]),
        null(n, longs), null(n, longs),
    ], names=names)
    for low in range(0, n, 4096):
        yield made.slice(low, 4096)


def build_index(docs: DataFrame, segment: int = SEGMENT) -> Index | None:
    """The index of all rows of docs; None if no text has a term. doc_id has to be a whole number or null."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    n = rows.select("text").mapInArrow(lambda b: _count(b), "docs long, terms long, bytes long").agg(*[F.sum(c).alias(c) for c in ("docs", "terms", "bytes")]).first()
    if not n.terms:
        return None
    n_docs, n_terms = n.docs, n.terms

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, parts, size, no = TaskContext.get().partitionId(), [], 0, 0
        for batch in sliced(batches):
            here = int(text_bytes(batch.column("text"))[0][-1])
            if parts and size + here > segment:
                yield from _segment(f"{name}:{no}", parts, n_docs, n_terms)
                parts, size, no = [], 0, no + 1
            parts.append(batch)
            size += here
        if parts:
            yield from _segment(f"{name}:{no}", parts, n_docs, n_terms)

    tasks = max(math.ceil(n.bytes / segment), docs.sparkSession.sparkContext.defaultParallelism)
    small = rows.coalesce(tasks)  # many small files make segments of some size, too
    return Index(stored(small.mapInArrow(lambda b: released(built(b)), INDEX)), n_docs, n_terms)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, term, n of each text of an item."""
    for batch in sliced(batches):
        terms, code, of = coded_terms(batch.column("text"), LETTERS)
        cell, n = np.unique(of * max(len(terms), 1) + code, return_counts=True)
        keys = batch.column("key").take(pa.array(cell // max(len(terms), 1)))
        yield pa.RecordBatch.from_arrays([keys, terms.take(pa.array(cell % max(len(terms), 1))).cast(pa.string()), pa.array(n.astype(np.int64))], names=["key", "term", "n"])


def added(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place, exact."""
    if len(values) and float(np.abs(values).astype(np.float64).sum()) >= EXACT:
        out = np.zeros(size, np.int64)
        np.add.at(out, at, values)
        return out
    return np.bincount(at, weights=values, minlength=size).astype(np.int64)


class Segment:
    """The blocks of some terms of a segment; a block is decoded when it is first wanted, and kept."""

    def __init__(self, m: np.ndarray, df: np.ndarray, blocks: np.ndarray, first: np.ndarray, last: np.ndarray, top: np.ndarray, wide: np.ndarray, data: np.ndarray):
        self.m, self.blocks, self.first, self.last, self.top, self.data = m, blocks, first, last, top, data
        self.begin = np.cumsum(blocks) - blocks
        self.count = np.full(len(first), BLOCK)
        self.count[self.begin + blocks - 1] = df - BLOCK * (blocks - 1)
        self.w_gap, self.w_tf = wide // 8, wide % 8
        size = self.count * (self.w_gap + self.w_tf)
        self.at = np.cumsum(size) - size
        self.start = np.cumsum(self.count) - self.count
        self.doc, self.impact = np.zeros((2, int(self.count.sum())), np.int64)
        self.decoded = np.zeros(len(first), bool)
        self.list_top = np.maximum.reduceat(top, self.begin) if len(top) else top

    def postings(self, blocks: np.ndarray) -> np.ndarray:
        """Places in doc and impact of the postings of blocks."""
        new = blocks[~self.decoded[blocks]]
        if len(new):
            count = self.count[new]
            gap = np.cumsum(unpacked(self.data, self.at[new], count, self.w_gap[new]))
            begin = np.cumsum(count) - count  # the first gap of a block is 0
            doc = gap - np.repeat(gap[begin] - self.first[new], count)
            tf = unpacked(self.data, self.at[new] + count * self.w_gap[new], count, self.w_tf[new]) + 1
            to = ranges(self.start[new], count)
            self.doc[to], self.impact[to] = doc, impacts(tf, self.m[doc])
            self.decoded[new] = True
        return ranges(self.start[blocks], self.count[blocks])

    def sums(self, blocks: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of each document the score by these blocks, whose terms have these weights."""
        at = self.postings(blocks)
        return added(self.doc[at], self.impact[at] * np.repeat(weight, self.count[blocks]), len(self.m))

    def best(self, terms: np.ndarray, weights: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k documents of highest score of at least `least` (over 0), equal scores by place, and the scores."""
        n, docs = self.blocks[terms], len(self.m)
        block, weight = ranges(self.begin[terms], n), np.repeat(weights, n)
        term = np.repeat(np.arange(len(terms)), n)
        high = self.top[block] * weight
        bound = np.cumsum(added(self.first[block], high, docs + 1) - added(self.last[block] + 1, high, docs + 1))[:docs]
        need = max(least, 1)
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        live = np.flatnonzero(bound >= need)
        head = np.sort(live[np.argpartition(-bound[live], HEAD)[:HEAD]]) if len(live) > HEAD else live
        rest = np.setdiff1d(live, head, assume_unique=True)
        lists = self.list_top[terms] * weights
        by_list = np.argsort(lists, kind="stable")
        total = np.cumsum(lists[by_list])
        for some in (head, rest):
            some = some[bound[some] >= need]
            if not len(some):
                continue
            weak = np.zeros(len(terms), bool)  # lists that together do not reach the threshold
            n_weak = int(np.searchsorted(total, need))
            weak[by_list[:n_weak]] = True
            spare = int(total[n_weak - 1]) if n_weak else 0
            held = np.searchsorted(some, self.last[block], "right") > np.searchsorted(some, self.first[block])
            use = np.flatnonzero(held & ~weak[term])
            sums = self.sums(block[use], weight[use])
            some = some[sums[some] + spare >= need]
            if n_weak and len(some):
                held = np.searchsorted(some, self.last[block], "right") > np.searchsorted(some, self.first[block])
                use = np.flatnonzero(held & weak[term])
                sums = sums + self.sums(block[use], weight[use])
            found, scores = np.append(found, some), np.append(scores, sums[some])
            order = np.lexsort((found, -scores))[:k]
            order = order[scores[order] >= need]
            found, scores = found[order], scores[order]
            if len(scores) == k:
                need = max(need, int(scores[-1]))
        return found, scores


def _searcher(k: int):
    def searched(table: pa.Table) -> pa.Table:
        """The best documents of a segment for each item of a block."""
        table = table.combine_chunks()
        info = table.filter(pc.is_null(table["term"]))
        rows = table.filter(pc.is_valid(table["term"])).combine_chunks()
        flat = lambda name: rows[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        keys, ids, scores = [], [], []
        if rows.num_rows and info.num_rows:
            doc_ids, m = info["ids"][0].values, info["m"][0].values.to_numpy().astype(np.int64)
            size = lambda name: pc.list_value_length(rows[name]).to_numpy().astype(np.int64)
            seg = Segment(m, rows["df"].to_numpy().astype(np.int64), size("first"), *(flat(c) for c in ("first", "last", "top", "widths")), text_bytes(rows["payload"].combine_chunks())[1])
            asked = rows["items"].combine_chunks()
            term, items = np.repeat(np.arange(rows.num_rows), size("items")), asked.flatten()
            coded = items.field("key").dictionary_encode()
            code, weight, least = coded.indices.to_numpy(), items.field("weight").to_numpy(), items.field("least").to_numpy()
            order = np.argsort(code, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(code))])
            for i, key in enumerate(coded.dictionary.to_pylist()):
                mine = order[cuts[i] : cuts[i + 1]]
                docs, values = seg.best(term[mine], weight[mine], int(least[mine[0]]), k)
                keys += [key] * len(docs)
                ids.append(docs)
                scores.append(values)
            found = doc_ids.take(pa.array(np.concatenate(ids)))
            return pa.table({"key": pa.array(keys, pa.string()), "doc_id": found, "score": pa.array(np.concatenate(scores))})
        return pa.table({"key": pa.array([], pa.string()), "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})

    return searched


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return hits.withColumn("rank", place).where(F.col("rank") <= k)


def search(index: Index | None, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: of each item the k documents of highest score over 0 (all, if fewer).

    Rows of one item_id are one item with all their terms (equal rows count once); a null item_id is one, too. Items
    without a known term have no hits. Equal scores are ranked by doc_id, null ones last. Other columns are not read.
    """
    key = F.to_json(F.struct(items["item_id"].alias("i")))
    texts = stored(items.select(items["item_id"], key.alias("key"), items["text"].cast("string").alias("text")).distinct())
    known = texts.select("key", "item_id").distinct()
    if index is None:
        return known.limit(0).select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    blocks = max(1, math.ceil(known.count() / ITEMS))
    asked = texts.select("key", "text").mapInArrow(lambda b: _asked(b), "key string, term string, n long").groupBy("key", "term").agg(F.sum("n").alias("n"))
    asked = stored(asked)
    postings = index.rows.where("term is not null").drop("ids", "m")
    df = postings.select("term", "df").join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("all_df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.docs + 2) / (2 * F.col("all_df") + 1)))
    weighted = stored(asked.join(df, "term").select("key", "term", (weight * F.col("n")).alias("weight"), F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")).where("weight > 0"))
    first = F.pmod(F.xxhash64("segment"), F.lit(FIRST)) == 0
    numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")

    def run(part, least: DataFrame | None) -> DataFrame:
        terms = weighted.withColumn("least", F.lit(0).cast("long")) if least is None else weighted.join(least, "key", "left").withColumn("least", F.coalesce("least", F.lit(0)))
        terms = terms.groupBy("block", "term").agg(F.collect_list(F.struct("key", "weight", "least")).alias("items"))  # the items of a block: ITEMS on average
        met = postings.where(part).join(terms, "term")
        info = index.rows.where(part & F.col("term").isNull()).select("*", numbers)
        return stored(met.unionByName(info, allowMissingColumns=True).groupBy("segment", "block").applyInArrow(_searcher(k), FOUND))

    early = run(first, None)
    least = _ranked(early, k).where(F.col("rank") == k).select("key", F.col("score").alias("least"))
    late = run(~first, least)
    out = stored(_ranked(early.unionByName(late), k).join(known, "key").select("item_id", "rank", "doc_id", "score"))
    discard(asked, weighted, early, late, texts)
    return out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """search() over an index of docs that is removed afterwards. Null texts have no terms; repeated rows are documents of their own; other columns are not read."""
    index = build_index(docs)
    out = search(index, items, k)
    if index is not None:
        discard(index.rows)
    return out


def rank_sql() -> str:
    """The same in DuckDB SQL over the views documents and benchmark."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS i, doc_id, text FROM documents),
    t AS (SELECT i, doc_id, term, count(*) AS tf FROM (SELECT i, doc_id, {terms} FROM d) GROUP BY ALL),
    s AS (SELECT i, sum(tf)::BIGINT AS n FROM t GROUP BY i),
    z AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM s),
    m AS (SELECT i, {100 - SLOPE} + ({SLOPE} * n * docs) // terms AS m FROM s, z),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, z GROUP BY term, docs),
    q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, {terms} FROM benchmark) GROUP BY ALL),
    p AS (SELECT item_id, i, doc_id, sum(qtf * w * (({SCALE}::BIGINT * tf) // (1000 * tf + {DAMP} * m)))::BIGINT AS score FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (i) GROUP BY ALL)
    SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM p WHERE score > 0) WHERE rank <= {TOP}"""
