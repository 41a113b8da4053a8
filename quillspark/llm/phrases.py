"""Substring deduplication: recurring 20-word windows, located by sharded Aho-Corasick automata.

1. Anchors. Of every window the 8-word phrase of smallest hash is its anchor: equal windows have equal anchors, and
   about one phrase in seven is one. Anchors are counted over all documents; those seen once are dropped.
2. Shards. The first document of a recurring anchor owns it. Anchors are dealt to shards by owner, so those of one
   passage stay together, and a document goes to the shards of its anchors only. A shard with many documents (a
   passage in a third of all rows, say) is salted: its owners go to every part, the other documents to one.
3. Automata. Each part confirms the phrases as text in their owners' documents, compiles them with pyahocorasick
   and streams its documents through. A window whose anchor was located is compared by 128 bits with the others
   of the part; later occurrences are marked. Only parts of salted shards compare their first ones with each other.
4. Marked windows are gathered per document and their words removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import durable, mixed, run_hashes, runs, sliced, text_bytes

WINDOW, PHRASE = 20, 8
INSIDE = WINDOW - PHRASE + 1
#: Patterns of an automaton and documents of a part, on average.
PATTERNS, DOCUMENTS = 3_000, 2_000
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
LAST = (1 << 63) - 1
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
TOP = np.uint64((1 << 64) - 1)


def sliding(x: np.ndarray, size: int, of: np.ufunc) -> np.ndarray:
    """of over each run of `size` neighbours; len(x) - size + 1 values."""
    width = 1
    while width * 2 <= size:
        x = of(x[:-width], x[width:])
        width *= 2
    return of(x[: len(x) - (size - width)], x[size - width :]) if size > width else x


def chained(word: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each run of `size` words, from hashes of the words."""
    n = len(word) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for i in range(size if n > 0 else 0):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + word[i : i + n]
    return mixed(total)


def anchors(phrase: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest phrase hash of each window (0 where the window crosses two texts), and which phrases are anchors."""
    n = len(phrase) - INSIDE + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(phrase), bool)
    low = sliding(phrase, INSIDE, np.minimum)
    low = np.where(text[:n] == text[WINDOW - 1 : WINDOW - 1 + n], low, 0)
    edge = np.zeros(INSIDE - 1, np.uint64)
    return low, sliding(np.concatenate([edge, low, edge]), INSIDE, np.maximum) == phrase


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        offsets, data = text_bytes(batch.column("text"))
        starts, ends, text = runs(~SPACE[data], offsets)
        phrase = chained(run_hashes(data, starts, ends, BASES[0]), PHRASE)
        _, chosen = anchors(phrase, text)
        at = np.flatnonzero(chosen)
        order = np.lexsort((phrase[at], text[at]))
        key, of = phrase[at][order], text[at][order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(new)
        n = np.minimum(np.diff(np.append(first, len(key))), 2)
        place = batch.column("place").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), pa.array(place[of[first]]), pa.array(n.astype(np.int32))], names=["anchor", "place", "n"])


def automaton(phrases: list[str]) -> ahocorasick.Automaton:
    """Finds phrases in texts whose words are parted, preceded and followed by one space."""
    out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for phrase in phrases:
        out.add_word(f" {phrase} ", 1)
    if phrases:
        out.make_automaton()
    return out


def occurrences(machine: ahocorasick.Automaton, words: list[str]) -> np.ndarray:
    """Index of the first word of every occurrence of a phrase."""
    if not len(machine) or len(words) < PHRASE:
        return np.zeros(0, np.int64)
    found = np.fromiter((end for end, _ in machine.iter(f" {' '.join(words)} ")), np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # place of the space behind each word
    return np.searchsorted(ends, found) - PHRASE + 1


class Text:
    """Words of a text and their hashes."""

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        self.starts, self.ends, at = runs(~SPACE[data], np.array([0, len(data)]))
        self.words = [w.decode() for w in raw.split()]
        self.hashes = [run_hashes(data, self.starts, self.ends, base) for base in BASES]
        self.phrase = chained(self.hashes[0], PHRASE)
        self.low, _ = anchors(self.phrase, at)


def _part(table: pa.Table) -> pa.Table:
    """Of the documents of one part of a shard: marked windows as runs, and, if the shard is salted, first ones as packs by span."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["place"], r["row"]))
    unpack = zstandard.ZstdDecompressor().decompress
    texts = [Text(unpack(r["packed"])) for r in rows]
    phrases: dict[int, str] = {}
    for r, t in zip(rows, texts, strict=True):
        if r["own"]:
            wanted = np.array(r["own"], np.int64).view(np.uint64)
            for p in np.flatnonzero(np.isin(t.phrase, wanted)).tolist():
                phrases.setdefault(int(t.phrase[p]), " ".join(t.words[p : p + PHRASE]))
    machine = automaton(sorted(set(phrases.values())))
    g1, g2, of, at = [], [], [], []
    for i, (r, t) in enumerate(zip(rows, texts, strict=True)):
        hit = occurrences(machine, t.words)
        if not len(hit) or not len(t.low):
            continue
        seen = np.full(len(t.phrase), TOP)
        seen[hit] = t.phrase[hit]
        windows = np.flatnonzero(sliding(seen, INSIDE, np.minimum) == t.low)  # those whose anchor is of this shard
        if len(windows):
            g1.append(chained(t.hashes[0], WINDOW)[windows])
            g2.append(chained(t.hashes[1], WINDOW)[windows])
            of.append(np.full(len(windows), i))
            at.append(windows)
    if not g1:
        return pa.table([pa.array([], k) for k in KINDS], names=NAMES)
    g1, g2, of, at = (np.concatenate(x) for x in (g1, g2, of, at))
    order = np.lexsort((np.arange(len(g1)), g2, g1))  # rows are in the order of documents
    same = np.zeros(len(g1), bool)
    same[1:] = (g1[order][1:] == g1[order][:-1]) & (g2[order][1:] == g2[order][:-1])
    later = np.zeros(len(g1), bool)
    later[order] = same
    # rows that are equal in id and text are one document: none is earlier than another
    document = np.cumsum([i > 0 and (rows[i]["place"], rows[i]["row"]) != (rows[i - 1]["place"], rows[i - 1]["row"]) for i in range(len(rows))])
    head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(g1))))]
    origin = np.empty(len(g1), np.int64)
    origin[order] = head
    later &= ~((document[of] == document[of[origin]]) & (at == at[origin]))
    place, row = np.array([r["place"] for r in rows]), np.array([r["row"] for r in rows])
    member = np.array([r["member"] for r in rows])[of]  # owners from other parts are only compared with
    out = _marked(place[of], row[of], at, later & member, of)
    if (parts := rows[0]["parts"]) > 1:
        o = np.flatnonzero(~later & member)
        span = (g1[o] % np.uint64(parts)).astype(np.int64)
        o, span = o[np.argsort(span, kind="stable")], np.sort(span)
        spans, first = np.unique(span, return_index=True)
        fields = np.stack([g1[o].view(np.int64), g2[o].view(np.int64), place[of[o]], row[of[o]], at[o]], axis=1)
        packs = [p.tobytes() for p in np.split(fields, first[1:])] if len(o) else []
        n, shard = len(packs), rows[0]["shard"]
        none = [pa.nulls(n, k) for k in KINDS[3:]]
        out = pa.concat_tables([out, pa.table([pa.array([shard] * n, KINDS[0]), pa.array(spans.astype(np.int32)), pa.array(packs, KINDS[2]), *none], names=NAMES)])
    return out


NAMES = ("shard", "span", "pack", "place", "row", "at", "n")
KINDS = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
JUDGED = "shard int, span int, pack binary, place bigint, row bigint, at int, n int"


def _marked(place: np.ndarray, row: np.ndarray, at: np.ndarray, mark: np.ndarray, of: np.ndarray) -> pa.Table:
    """The marked ones of windows, which are in the order of documents (numbered by of) and places, as runs."""
    place, row, at, of = place[mark], row[mark], at[mark], of[mark]
    cut = np.ones(len(of), bool)
    cut[1:] = (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(cut)
    n = np.diff(np.append(first, len(of))).astype(np.int32)
    none = [pa.nulls(len(first), k) for k in KINDS[:3]]
    return pa.table([*none, pa.array(place[first]), pa.array(row[first]), pa.array(at[first].astype(np.int32)), pa.array(n)], names=NAMES)


def _across(table: pa.Table) -> pa.Table:
    """Of the windows in packs from all parts of a shard: those that also begin earlier, as runs."""
    fields = np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 5) for p in table.column("pack").to_pylist()])
    g1, g2, place, row, at = fields[np.lexsort(fields.T[::-1])].T  # equal windows lie together, the earliest first
    same = np.zeros(len(g1), bool)
    same[1:] = (g1[1:] == g1[:-1]) & (g2[1:] == g2[:-1])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(g1))))
    late = same & ((place != place[head]) | (row != row[head]) | (at != at[head]))
    order = np.lexsort((at, row, place))
    place, row, at, late = place[order], row[order], at[order], late[order]
    other = np.zeros(len(place), np.int64)
    other[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    return _marked(place, row, at, late, np.cumsum(other))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        at = batch.schema.get_field_index("text")
        packed = pa.array([pack(t.encode()) for t in batch.column(at).to_pylist()], pa.binary())
        yield batch.set_column(at, "packed", packed)


def _packed(rows: DataFrame) -> DataFrame:
    """Rows with the text as a zstandard frame, which takes less of a shuffle than Spark's own compression leaves."""
    return rows.mapInArrow(_pack, "place bigint, row bigint, doc_id bigint, packed binary")


def _place(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit(LAST))


def _rows(docs: DataFrame) -> DataFrame:
    """place (the order of documents: doc_id, nulls last), row (hash of the text), doc_id, text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(_place(F.col("doc_id")).alias("place"), F.xxhash64(text).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """place, row, at, n: runs of windows (first word of the first window, number) that have an earlier occurrence."""
    rows = _rows(docs)
    found = rows.select("place", "text").mapInArrow(_anchor_rows, "anchor bigint, place bigint, n int")
    counted = found.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    several = durable(found.select("anchor", "place").join(counted, "anchor"))
    recurring = durable(several.groupBy("anchor").agg(F.min("place").alias("owner")))
    shards = max(1, -(-recurring.count() // PATTERNS))
    recurring = recurring.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(shards)).cast("int"))
    routes = durable(several.join(recurring.select("anchor", "shard"), "anchor").select("place", "shard").distinct())
    own = recurring.groupBy(F.col("owner").alias("place"), "shard").agg(F.collect_list("anchor").alias("own"))  # anchors of one text
    sizes = routes.groupBy("shard").agg(F.ceil(F.count("*") / DOCUMENTS).cast("int").alias("parts"))
    ways = routes.join(own, ["place", "shard"], "left").join(sizes, "shard")
    ways = ways.withColumn("part", F.pmod(F.xxhash64("place", F.lit(1)), F.col("parts")).cast("int"))
    every = F.when(F.col("own").isNull(), F.array("part")).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    ways = ways.select("place", "shard", "parts", "own", "part", F.explode(every).alias("to"))
    sent = _packed(rows).join(ways, "place")
    sent = sent.select("place", "row", "packed", "shard", "parts", "to", "own", (F.col("to") == F.col("part")).alias("member"))
    judged = durable(sent.groupBy("shard", "to").applyInArrow(_part, JUDGED))
    late = judged.where("pack is not null").select("shard", "span", "pack").groupBy("shard", "span").applyInArrow(_across, JUDGED)
    return judged.where("pack is null").unionByName(late).select("place", "row", "at", "n")


def _without(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows = []
        for doc_id, packed, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "spans")), strict=True):
            words = unpack(packed).split()
            cover = np.zeros(len(words) + 1, np.int64)
            for s in spans or ():
                cover[s["at"]] += 1
                cover[s["at"] + s["n"] + WINDOW - 1] -= 1
            keep = np.cumsum(cover)[:-1] == 0
            kept = b" ".join(words if keep.all() else [words[i] for i in np.flatnonzero(keep)])
            rows.append((doc_id, len(words), int(len(words) - keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if keep_text else None))
        names, kinds = ["doc_id", "n_words", "n_removed", "kept_sha256", "text"], (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns[: 4 + keep_text], names=names[: 4 + keep_text])


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if wanted, the kept text of every row of docs.

    Words are runs of other bytes than space and 9 to 13. A word goes if a window of 20 words that covers it also
    begins earlier: in a document of smaller doc_id, or further ahead in the same one. Windows are judged on the input.
    A null text has no words. Rows with a null doc_id come after all others, ordered by a hash of the text, as are
    rows that share a doc_id; rows equal in doc_id and text are one document, so none is earlier than the other.
    Texts of under 20 words lose nothing. Other columns are not read; an empty table gives no rows.
    """
    spans = repeated_windows(docs).groupBy("place", "row").agg(F.collect_list(F.struct("at", "n")).alias("spans"))  # of one text
    joined = _packed(_rows(docs)).join(spans, ["place", "row"], "left").select("doc_id", "packed", "spans")
    kinds = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", text string" if keep_text else "")
    return joined.mapInArrow(lambda b: _without(b, keep_text), kinds)
