"""SimHash near-duplicates: exact comparison of fingerprint tiles with numpy exclusive-or and bit counts.

Distinct fingerprints are dealt to cells by the population counts of their four 16-bit quarters. The counts of two
fingerprints differ, summed over the quarters, by no more than their differing bits, so only cells within the radius
of each other are compared; the rest are skipped without loss. Large cells are cut into tiles of bounded size. From a
tile pair come only the links of a spanning forest, so a large group of near copies does not yield all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import durable, fresh, released, sliced
from quillspark.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints in a tile, on average.
TILE = 1024


def fingerprint(raw: bytes) -> int:
    """Of UTF-8 text: each bit set in over half of the XXH64 hashes of its 3-word shingles (repeats count)."""
    words = raw.lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), len(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, n) - 1).tolist()
    hash_, stops = xxhash.xxh64_intdigest, (ends - 1).tolist()
    hashes = np.array([hash_(line[a:b], SEED) for a, b in zip(starts, stops[SHINGLE - 1 :], strict=False)], ">u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        total += np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        prints = np.array([fingerprint(t.encode()) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed integer) of every row; null and wordless texts have 0."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: released(_fingerprints(b)), "doc_id bigint, fp bigint")


def spanning(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Indexes of links (left[i], right[i]) between n nodes that join all that the links join, without a cycle."""
    label = np.arange(n)
    kept: list[np.ndarray] = []
    at = np.arange(len(left))
    while len(at):
        a, b = label[left[at]], label[right[at]]
        open_ = a != b
        at, a, b = at[open_], a[open_], b[open_]
        if not len(at):
            break
        high, low = np.maximum(a, b), np.minimum(a, b)
        _, first = np.unique(high, return_index=True)  # each label but the lowest takes one link to a lower label
        kept.append(at[first])
        label[high[first]] = low[first]
        while (label[label] != label).any():
            label = label[label]
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a_of, b_of = [], []
        for one, other, own in zip(*(batch.column(c) for c in ("one", "other", "own")), strict=True):
            a, b = (np.frombuffer(x.as_buffer(), ">u8").astype(np.uint64) for x in (one, other))
            left, right = [], []
            for start in range(0, len(a), 256):
                i, j = np.nonzero(np.bitwise_count(a[start : start + 256, None] ^ b[None, :]) <= radius)
                i += start
                if own.as_py():
                    i, j = i[i < j], j[i < j]
                left.append(i)
                right.append(j)
            i, j = np.concatenate(left), np.concatenate(right)
            if len(i):
                keep = spanning(i, j if own.as_py() else j + len(a), len(a) + len(b))
                a_of.append(a[i[keep]])
                b_of.append(b[j[keep]])
        if a_of:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a_of, b_of)], names=["a", "b"])


def quarters(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(0xFFFF)) for i in range(4)]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between the fingerprints of the column fp (distinct) that join all within the radius."""
    cell = sum((q * F.lit(17**i) for i, q in enumerate(quarters(F.col("fp")))), F.lit(0)).cast("int")
    cells = distinct.select("fp", cell.alias("cell"))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("n_tiles"))  # 17**4 rows at most
    dealt = cells.join(F.broadcast(sizes), "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("n_tiles")).cast("int"))
    tiles = dealt.groupBy("cell", "tile").agg(F.unhex(F.array_join(F.collect_list(F.lpad(F.hex("fp"), 16, "0")), "")).alias("fps"))
    tiles = durable(tiles)
    steps = [s for s in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]
    parts = [F.floor(F.col("cell") / 17**i).cast("int") % 17 for i in range(4)]
    near = F.array(*[F.struct(*[F.lit(x).alias(f"s{i}") for i, x in enumerate(s)]) for s in steps])
    moved = [(parts[i] + F.col("near")[f"s{i}"]).alias(f"q{i}") for i in range(4)]
    left = tiles.select("tile", F.col("fps").alias("one"), "cell", F.explode(near).alias("near")).select("tile", "one", F.col("cell").alias("from"), *moved)
    left = left.where(" and ".join(f"q{i} between 0 and 16" for i in range(4)))
    left = left.withColumn("cell", F.expr("q0 + q1 * 17 + q2 * 289 + q3 * 4913").cast("int"))
    right = tiles.select("cell", F.col("tile").alias("tile_b"), F.col("fps").alias("other"))
    pairs = left.join(right, "cell").where("cell <> `from` or tile <= tile_b")
    pairs = pairs.select("one", "other", F.expr("cell = `from` and tile = tile_b").alias("own"))
    return pairs.mapInArrow(lambda b: _compare(b, radius), "a bigint, b bigint")


def group(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of docs.

    component_id is the smallest doc_id among the documents that a chain of fingerprints, each within the radius of
    the next, reaches. Null, empty and wordless texts have fingerprint zero and are linked like any others. A row
    with a null doc_id has a fingerprint but no component, and joins none. Repeated rows are repeated in the result.
    Other columns are not read; an empty table gives no rows.
    """
    prints = durable(fingerprints(docs))
    distinct = durable(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp"), radius))
    if roots is None:
        known = distinct.select("fp", F.col("first").alias("component_id"))
    else:
        rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
        lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
        known = rooted.join(lowest, "root").select("fp", "component_id")
    out = prints.join(known, "fp", "left")
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id; all columns as they are.

    Of rows that share that doc_id the one whose text has the smallest hash stays. Rows with a null doc_id are compared with none and stay.
    """
    id_, place = fresh(docs, "chosen_id"), fresh(docs, "place")
    chosen = group(docs, radius).where("doc_id = component_id").select(F.col("doc_id").alias(id_)).distinct()
    kept = docs.join(chosen, docs["doc_id"].cast("bigint") == F.col(id_), "left_semi")
    one = kept.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(F.col("text").cast("string"))))).where(F.col(place) == 1).drop(place)
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
