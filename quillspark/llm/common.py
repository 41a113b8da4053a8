"""Helpers that the training-data operators share: tables, durable intermediate results, texts as byte arrays."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about this many bytes; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, spark.checkpoint.dir. Where a session names none, a temporary one serves in local mode; a cluster has to name one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The rows of df, written to the cluster's shared checkpoint folder, so that lost executors cost nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As durable, but as a Parquet table in that folder: smaller, and read by columns. For steps with many plain rows.

    discard() removes it; as with checkpoints, whoever owns the folder clears the rest when the application has ended.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables of stored(). Only for those that nothing still reads: what was made of them is stored itself."""
    for df in tables:
        session = df.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that models never learn from (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sliced(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in batches whose texts have about `limit` bytes; null texts become empty."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        batch = batch.set_column(at, column, batch.column(at).fill_null(""))
        ends = np.cumsum(np.diff(text_bytes(batch.column(at))[0]))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0, one more than texts) and the UTF-8 bytes of an array of texts without nulls."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return ends - ends[0], raw


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below n at least; base is odd."""
    if base not in _powers or len(_powers[base][0]) < n:
        m = max(n, SLICE_BYTES + 4096)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(m, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        if m > 4 * SLICE_BYTES:  # a very long text; not kept
            return both[0], both[1]
        _powers[base] = (both[0], both[1])
    return _powers[base]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that no text's end cuts: first byte, byte after the last, index of the text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = offsets[(offsets > 0) & (offsets < len(inside))]
    first[inner] |= inside[inner]
    last[inner - 1] |= inside[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """64-bit polynomial hash of data[start:end] for each run, scrambled."""
    up, down = powers(base, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    each = total[1:]  # worked out in place, as each of these arrays has eight times the bytes of the texts
    each[:] = data
    each += np.uint64(1)
    each *= up[: len(data)]
    np.cumsum(each, out=each)
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Returns memory that this process no longer needs to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; then the worker, which outlives the task, gives memory back."""
    try:
        yield from batches
    finally:
        give_back()


def letters_table(digits: bool) -> np.ndarray:
    """Which bytes of UTF-8 make up terms: ASCII letters, all of characters beyond ASCII and, if wanted, ASCII digits."""
    out = np.zeros(256, bool)
    out[128:] = out[65:91] = out[97:123] = True
    out[48:58] = digits
    return out


#: Each byte with A-Z in small letters.
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32


def coded_terms(texts: pa.Array, letters: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms (runs of `letters`, A-Z in small letters) of texts without nulls; for each occurrence, in order, its term's place there and its text's index."""
    offsets, data = text_bytes(texts)
    inside = letters[data]
    starts, ends, of = runs(inside, offsets)
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=places[1:])
    wide = places[-1] >= 1 << 31
    kind = pa.LargeStringArray if wide else pa.StringArray
    terms = kind.from_buffers(len(starts), pa.py_buffer(places if wide else places.astype(np.int32)), pa.py_buffer(SMALL[data[inside]]))
    coded = terms.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), of
