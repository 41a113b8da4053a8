"""Sharding: groups of equal texts are dealt to shards by Karmarkar-Karp differencing of their bytes.

A partial partition has a sum for each bin. The two of largest spread are combined again and again, the large sums of
one with the small ones of the other, until one is left. Groups are dealt by hash to buckets of about a thousand; each
bucket's task packs its groups into 16 chunks by differencing, and chunks are packed again, each level 64 times smaller
than the one before, until DRIVER_ITEMS or fewer are left for the driver, however many documents there are. A group over
the fair share of a bin gets a bin of its own, and the rest is differenced without it.

Equal texts stay together, so a group that is larger than a shard's fair share makes its shard the largest. Only the
group is one item of the packing: its rows are numbered in blocks, and joined by broadcast if they are many.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import discard, fresh, stored

SHARDS = 16
#: Items of a bucket on average, and the chunks made of them.
BUCKET, CHUNKS = 1024, 16
#: Items that the driver packs at most.
DRIVER_ITEMS = 16_384
#: A group with this part of all rows or more is joined by broadcast: there are at most so many.
HOT = 1024
#: Rows of a block that are numbered together, on average, and the least number of blocks of a shard.
BLOCK_ROWS, BLOCKS = 50_000, 32


def differenced(sizes: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each item; sizes are whole numbers, none negative. Equal spreads are combined in the order of the items."""
    sizes = np.asarray(sizes, np.int64)
    out = np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    rest, left = int(sizes.sum()), bins
    for n in range(min(bins - 1, len(order))):  # items over the fair share of the bins that are left
        if int(sizes[order[n]]) * left <= rest:
            break
        left -= 1
        rest -= int(sizes[order[n]])
        out[order[n]] = left
    order = order[bins - left :]
    if not len(order):
        return out
    m = len(order)
    sums = np.zeros((2 * m - 1, left), np.int64)  # of each partial partition, in falling order
    sums[:m, 0] = sizes[order]
    sides = np.zeros((2 * m - 1, 2), np.int64)
    turned = np.zeros((2 * m - 1, left), np.int32)  # which bin of the first one went to which place
    heap = [(-int(s), i) for i, s in enumerate(sizes[order])]
    for new in range(m, 2 * m - 1):
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums[a] + sums[b][::-1]
        place = np.argsort(-both, kind="stable")
        sums[new], sides[new], turned[new] = both[place], (a, b), place
        heapq.heappush(heap, (int(sums[new, -1] - sums[new, 0]), new))
    label = np.zeros((2 * m - 1, left), np.int32)
    label[-1] = np.arange(left)
    for new in range(2 * m - 2, m - 1, -1):
        a, b = sides[new]
        label[a][turned[new]] = label[new]
        label[b] = label[a][::-1]
    out[order] = label[:m, 0]
    return out


def _chunked(table: pa.Table) -> pa.Table:
    table = table.sort_by("key")  # an order that a repeated task has, too
    bucket = table["bucket"][0].as_py()
    bins = differenced(table["size"].to_numpy(), CHUNKS)
    chunk = pa.array([f"{bucket}:{b}" for b in bins.tolist()], pa.string())
    return pa.table({"key": table["key"].cast(pa.string()), "chunk": chunk, "size": table["size"].cast(pa.int64())})


def packed(items: DataFrame, bins: int = SHARDS) -> DataFrame:
    """(key, bin) of every item; items has key, a string that occurs once, and size."""
    level, steps = items.select("key", "size"), []
    while (n := level.count()) > DRIVER_ITEMS:
        bucket = F.pmod(F.xxhash64("key"), F.lit(math.ceil(n / BUCKET)))
        step = stored(level.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_chunked, "key string, chunk string, size long"))
        steps.append(step)
        level = step.groupBy(F.col("chunk").alias("key")).agg(F.sum("size").alias("size"))
    rows = sorted((r.key, r.size) for r in level.select("key", F.col("size").alias("size")).toLocalIterator())
    found = differenced(np.array([s for _, s in rows], np.int64), bins).tolist()
    out = F.broadcast(items.sparkSession.createDataFrame([(k, b) for (k, _), b in zip(rows, found, strict=True)], "key string, bin int"))  # DRIVER_ITEMS rows at most
    for step in reversed(steps):
        out = step.select("key", "chunk").join(out.withColumnRenamed("key", "chunk"), "chunk").select("key", "bin")
    made = stored(out)
    discard(*steps)
    return made


def shard_of_texts(rows: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(key, bin) of every group of rows of one key, and of those with many rows again; rows has key and size."""
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    total = groups.agg(F.sum("n")).first()[0] or 0
    bins = packed(groups, shards)
    hot = stored(groups.where(F.col("n") * HOT >= total).select("key").join(bins, "key"))
    discard(groups)
    return bins, hot


def joined(rows: DataFrame, bins: DataFrame, hot: DataFrame, shard: str) -> DataFrame:
    """rows with the bin of their key, as column shard: frequent keys by broadcast (HOT rows at most), others by shuffle."""
    known = rows.join(F.broadcast(hot.withColumnRenamed("bin", shard)), "key", "left")
    rest = known.where(F.col(shard).isNull()).drop(shard).join(bins.withColumnRenamed("bin", shard), "key")
    return known.where(F.col(shard).isNotNull()).unionByName(rest)


def numbered(rows: DataFrame, n_rows: int, shards: int = SHARDS) -> DataFrame:
    """rows with slot, from 0 without gaps in each shard: blocks are numbered by themselves, and begin where the block before ends."""
    blocks = max(BLOCKS, math.ceil(n_rows / shards / BLOCK_ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "key"), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = counts.select("shard", "block", before.alias("begin"))
    place = F.row_number().over(Window.partitionBy("shard", "block").orderBy(F.col("doc_id").asc_nulls_last(), "key"))
    return rows.withColumn("place", place).join(begins, ["shard", "block"]).withColumn("slot", F.col("begin") + F.col("place") - 1)


def _text(docs: DataFrame):
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null) of every row of docs.

    size: bytes of the text and one more. Null texts count as empty ones and are one group with them; null doc_ids stay
    and are last in their block; repeated rows have a slot each, in the same shard; other columns are not read. Equal
    texts are told by MD5. An empty table gives no rows. Long texts need no more memory than the row itself.
    """
    text = _text(docs)
    rows = stored(docs.select(docs["doc_id"], (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("key")))
    bins, hot = shard_of_texts(rows, shards)
    with_shard = stored(joined(rows, bins, hot, "shard"))
    discard(rows, bins, hot)
    out = numbered(with_shard, with_shard.count(), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int = SHARDS, column: str = "shard") -> DataFrame:
    """All columns of docs and the shard of each row, by the same law; a column of that name gets another name for the shard."""
    key, name = fresh(docs, "key"), fresh(docs, column)
    text = _text(docs)
    bins, hot = shard_of_texts(docs.select(F.md5(text).alias("key"), (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size")), shards)
    rows, out = docs.withColumn(key, F.md5(text)), [*docs.columns, name]
    known = rows.join(F.broadcast(hot.withColumnsRenamed({"key": key, "bin": name})), key, "left")
    rest = known.where(F.col(name).isNull()).drop(name).join(bins.withColumnsRenamed({"key": key, "bin": name}), key)
    return known.where(F.col(name).isNotNull()).select(out).unionByName(rest.select(out))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files: int = 4) -> None:
    """docs as Parquet, one folder a shard, in about `files` files each."""
    name = fresh(docs, "shard")
    rows = sharded(docs, shards)
    salt = F.pmod(F.xxhash64(*docs.columns), F.lit(files))
    rows.repartition(shards * files, name, salt).write.partitionBy(name).parquet(path)
