"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Benchmark items are cut into overlapping segments. A text region within e edits of a segment of m bytes shares at
least m + 1 - (e + 1) * q of its q-grams with it, on at most e + 1 neighbouring diagonals. So shared q-grams are
counted in overlapping bands of diagonals, bands that reach that bound are kept, and a banded alignment decides.
All positions of a batch of texts are hashed, counted and aligned together with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import SLICE_BYTES, released, sliced, stored, text_bytes

#: Segments have SEGMENT bytes and begin every STRIDE; a shorter item is one segment. Items under LEAST bytes have to occur as they are.
SEGMENT, STRIDE, LEAST = 64, 32, 20
#: Bytes of a q-gram, and of those of segments so short that longer ones would not leave room for a tenth of edits.
Q, SMALL_Q, ERROR_RATE = 8, 4, 0.1
#: Items are given to the workers in shares of about so many bytes; more than one share means more passes over the texts.
SHARE_BYTES = 4 << 20
BASE = 0x9E3779B97F4A7C15
FILTER_BITS = 22

SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32
SMALL[[9, 10, 11, 12, 13]] = 32


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ASCII lower case, runs of white space as one space: bytes, offsets, and where each byte was."""
    low = SMALL[data]
    keep = low != 32
    if len(low):
        keep[1:] |= low[:-1] != 32
        keep[offsets[:-1][offsets[:-1] < len(low)]] = True
    at = np.flatnonzero(keep)
    return low[at], np.searchsorted(at, offsets), at


def budget(m: int) -> int:
    """Edits allowed in a segment of m bytes: a tenth, or none in one under LEAST."""
    return int(m * ERROR_RATE) if m >= LEAST else 0


@dataclass
class Grams:
    """The q-grams of those segments that are looked for by this q."""

    q: int
    grams: np.ndarray  # sorted; entries first[i] .. first[i + 1] are where gram i is
    first: np.ndarray
    segment_of: np.ndarray
    place_of: np.ndarray
    seen: np.ndarray


@dataclass
class Index:
    """Segments of one share of the items. short: those under LEAST bytes, by the bytes that they begin with."""

    items: list[int]
    segments: list[bytes]
    item_of: np.ndarray
    sizes: np.ndarray
    edits: np.ndarray
    tables: list[Grams]
    short: dict[int, dict[int, list[int]]]


def grams_of(data: np.ndarray, q: int = Q) -> np.ndarray:
    """The q-grams at every position that has one: q bytes as a number."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(data) - q + 1, np.uint64)
    for i in range(q):
        out |= data[i : len(data) - q + 1 + i].astype(np.uint64) << np.uint64(8 * i)
    return out


def slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(BASE)) >> np.uint64(64 - FILTER_BITS)


def build(items: list[tuple[int, str]]) -> Index:
    segments, item_of = [], []
    for n, (_, text) in enumerate(items):
        raw = np.frombuffer(text.encode(), np.uint8)
        body = normal(raw, np.array([0, len(raw)]))[0].tobytes().strip()
        if not body:
            continue
        last = max(0, len(body) - SEGMENT)
        for at in sorted({*range(0, last + 1, STRIDE), last}):
            segments.append(body[at : at + SEGMENT])
            item_of.append(n)
    sizes = np.array([len(s) for s in segments], np.int64)
    edits = np.array([budget(int(m)) for m in sizes], np.int64)
    roomy = sizes + 1 - (edits + 1) * Q >= 1  # the lemma demands a shared q-gram
    tables = [grams_table(segments, np.flatnonzero((sizes >= LEAST) & (roomy == (q == Q))), q) for q in (Q, SMALL_Q)]
    short: dict[int, dict[int, list[int]]] = {}
    for s in np.flatnonzero(sizes < LEAST).tolist():
        q = min(SMALL_Q, len(segments[s]))
        short.setdefault(q, {}).setdefault(int.from_bytes(segments[s][:q], "little"), []).append(s)
    return Index([i for i, _ in items], segments, np.array(item_of, np.int64), sizes, edits, [t for t in tables if len(t.grams)], short)


def grams_table(segments: list[bytes], chosen: np.ndarray, q: int) -> Grams:
    entries = sorted((g, s, p) for s in chosen.tolist() for p, g in enumerate(grams_of(np.frombuffer(segments[s], np.uint8), q).tolist()))
    grams, first = np.unique(np.array([e[0] for e in entries], np.uint64), return_index=True)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[slot(grams)] = True
    return Grams(q, grams, np.append(first, len(entries)), np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries], np.int64), seen)


def least_edits(pattern: np.ndarray, data: np.ndarray, start: np.ndarray, width: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Banded alignment of one pattern with many places: fewest edits between the whole pattern and any region.

    Diagonals start[i] .. start[i] + width - 1 of data are tried; bytes outside low[i] .. high[i] match nothing.
    Also gives the end of a best region (the first such).
    """
    n, far = len(start), len(pattern) + 1
    k = np.arange(width)
    cost = np.zeros((n, width), np.int32)
    for i, c in enumerate(pattern):
        at = start[:, None] + k + i
        inside = (at >= low[:, None]) & (at < high[:, None])
        same = inside & (data[np.clip(at, 0, len(data) - 1)] == c)
        new = cost + ~same
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)  # the pattern's byte is left out
        cost = np.minimum(np.minimum.accumulate(new - k, axis=1) + k, far)  # a byte of the text is left out
    best = cost.argmin(axis=1)
    return cost[np.arange(n), best], start + best + len(pattern)


def regions(index: Index, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of regions within the budget of a segment: text, segment, edits, end in the normal bytes."""
    found = [x for t in index.tables for x in near_regions(index, t, data, offsets)] + equal_regions(index, data, offsets)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4


def equal_regions(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Occurrences of short segments, not within longer runs of ASCII letters and digits."""
    inner = np.zeros(256, bool)
    inner[[*range(48, 58), *range(97, 123)]] = True
    out: list[tuple[np.ndarray, ...]] = []
    for q, heads in index.short.items():
        grams = grams_of(data, q)
        maybe = np.flatnonzero(np.isin(grams, np.array(sorted(heads), np.uint64)))
        order = maybe[np.argsort(grams[maybe], kind="stable")]
        for head, own in heads.items():
            low, high = np.searchsorted(grams[order], [head, head + 1])
            for s in own:
                m, pattern = int(index.sizes[s]), np.frombuffer(index.segments[s], np.uint8)
                at = order[low:high]
                text = np.searchsorted(offsets, at, side="right") - 1
                ok = at + m <= offsets[text + 1]
                at, text = at[ok], text[ok]
                for k in range(q, m):
                    ok = data[at + k] == pattern[k]
                    at, text = at[ok], text[ok]
                left = (at > offsets[text]) & inner[data[np.maximum(at - 1, 0)]] & inner[pattern[0]]
                right = (at + m < offsets[text + 1]) & inner[data[np.minimum(at + m, len(data) - 1)]] & inner[pattern[-1]]
                at, text = at[~(left | right)], text[~(left | right)]
                if len(at):
                    out.append((text, np.full(len(at), s), np.zeros(len(at), np.int64), at + m))
    return out


def near_regions(index: Index, table: Grams, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    grams = grams_of(data, table.q)
    maybe = np.flatnonzero(table.seen[slot(grams)])
    found = np.searchsorted(table.grams, grams[maybe])
    real = found < len(table.grams)
    real[real] = table.grams[found[real]] == grams[maybe[real]]
    maybe, found = maybe[real], found[real]
    many = table.first[found + 1] - table.first[found]
    entry = np.repeat(table.first[found] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    segment = table.segment_of[entry]
    diagonal = np.repeat(maybe, many) - table.place_of[entry]
    band_size = index.edits[segment] + 1
    band = (diagonal + SEGMENT) // band_size  # not negative
    span = int(len(data) + 2 * SEGMENT + 2)
    key, count = np.unique(segment * span + band, return_counts=True)
    need = index.sizes + 1 - (index.edits + 1) * table.q
    after = np.append((key[1:] == key[:-1] + 1) * count[1:], 0)  # overlapping bands: each with its neighbour
    own = key // span
    reach = count + after >= need[own]
    lone = np.append(False, key[1:] == key[:-1] + 1)  # the neighbour before already has these diagonals
    before = np.append(0, count[:-1]) * lone
    reach |= count + before >= need[own]
    key, own = key[reach], own[reach]
    band = key - own * span
    out: list[tuple[np.ndarray, ...]] = []
    for s in np.unique(own):
        e, pattern = int(index.edits[s]), np.frombuffer(index.segments[s], np.uint8)
        first = band[own == s] * (e + 1) - SEGMENT
        # the band and both neighbours, and room for the edits before the first shared q-gram
        start, width = first - 2 * (e + 1), 5 * (e + 1) + 1
        text = np.clip(np.searchsorted(offsets, np.clip(first + len(pattern) // 2, 0, len(data) - 1), side="right") - 1, 0, len(offsets) - 2)
        edits, end = least_edits(pattern, data, start, width, offsets[text], offsets[text + 1])
        good = edits <= e
        if good.any():
            out.append((text[good], np.full(good.sum(), s), edits[good].astype(np.int64), end[good]))
    return out


def _match(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, limit=SLICE_BYTES):
        offsets, raw = text_bytes(batch.column("text"))
        data, offsets, place = normal(raw, offsets)
        text, segment, edits, end = regions(index, data, offsets)
        if not len(text):
            continue
        doc_ids = batch.column("doc_id").to_pylist()
        best: dict[tuple[int, int], tuple] = {}
        for t, s, e, z in zip(text.tolist(), segment.tolist(), edits.tolist(), end.tolist(), strict=True):
            item = int(index.item_of[s])
            one = best.setdefault((t, item), (set(), []))
            one[0].add(s)
            one[1].append((e, z))
        rows = [
            (doc_ids[t], index.items[item], len(found), int((index.item_of == item).sum()), min(ends)[0]) for (t, item), (found, ends) in sorted(best.items())
        ]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "n_found", "n_segments", "least_edits"]
        )


def shares(benchmark: DataFrame, share_bytes: int = SHARE_BYTES) -> Iterator[Index]:
    """Indexes of the items, of bounded size each, made one after the other: the callers store what one gives before they take the next, so the driver holds one at a time."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // share_bytes)
    for i in range(n):
        share = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items
        yield build(sorted(((r.item_id, r.text) for r in share.collect()), key=lambda r: (r[0] is None, r)))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_found, n_segments, least_edits: benchmark items of which a segment is in a document.

    A segment (64 bytes of an item in normal form, every 32 bytes; a shorter item whole) is in a document if some
    region of its whole text, in normal form, is within a tenth of the segment's bytes in edits. n_found of the
    item's n_segments were found; least_edits is the fewest edits among them. An item of under LEAST bytes has to occur
    as it is, at the bounds of a word. Null and empty texts on either side match nothing; very long texts are read whole. Rows of docs with a null doc_id are reported with it; repeated
    rows are reported once each, repeated items once. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id bigint, item_id bigint, n_found int, n_segments int, least_edits int"
    parts: list[DataFrame] = []
    for index in shares(benchmark):
        if parts:
            parts[-1] = stored(parts[-1])
        parts.append(rows.mapInArrow(lambda b, index=index: _match(b, index), kinds))
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], kinds)


def _clean(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for part in sliced([batch.select([batch.schema.get_field_index("text")])], limit=SLICE_BYTES):
            offsets, raw = text_bytes(part.column("text"))
            data, offsets, _ = normal(raw, offsets)
            keep = np.ones(part.num_rows, bool)
            keep[regions(index, data, offsets)[0]] = False
            yield batch.slice(at, part.num_rows).filter(pa.array(keep))
            at += part.num_rows


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in which no segment of the benchmark is found; all columns as they are, null texts too."""
    for n, index in enumerate(shares(benchmark)):
        if n:
            docs = stored(docs)
        docs = docs.mapInArrow(lambda b, index=index: released(_clean(b, index)), docs.schema)
    return docs
