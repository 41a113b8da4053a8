"""Telephony audio in media columns: G.711 and ADPCM samples, stored and read back, expanded and resampled.

Samples of all texts of an Arrow batch are worked on together: companded samples expand through 256-entry
tables, and the nibbles of ADPCM blocks decode in lock step, one numpy operation for all blocks at a time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import SLICE_BYTES, sliced, text_bytes

#: Payloads are padded with PAD to a positive multiple of FRAME bytes; an ADPCM block has BLOCK bytes.
FRAME, PAD, BLOCK, RATE = 576, 255, 36, 8000
#: Format tags of RIFF/WAVE.
PCM, A_LAW, MU_LAW = 1, 6, 7
#: Steps and index changes of IMA ADPCM.
INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)
STEP = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190,
    209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272,
    2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500,
    20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)


def mu_law_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((code & 0x0F) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 0x80, -size, size).astype(np.int16)


def a_law_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    segment, low = (code >> 4) & 7, (code & 0x0F) << 4
    size = np.where(segment == 0, low + 8, (low + 0x108) << np.maximum(segment - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


MU, A = mu_law_table(), a_law_table()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """IMA ADPCM, mono: (n, size) bytes to (n, 1 + 2 * (size - 4)) samples. Step indexes over 88 count as 88."""
    n, size = blocks.shape
    out = np.empty((1 + 2 * (size - 4), n), np.int16)
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32)
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for i in range(2 * (size - 4)):
        code = ((codes[i >> 1] >> 4) if i & 1 else codes[i >> 1] & 15).astype(np.int32)
        step = STEP[index]
        change = step >> 3
        change += np.where(code & 4, step, 0)
        change += np.where(code & 2, step >> 1, 0)
        change += np.where(code & 1, step >> 2, 0)
        value = np.clip(value + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + INDEX[code], 0, 88)
        out[i + 1] = value
    return np.ascontiguousarray(out.T)


def doubled(pcm: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Samples at twice the rate: each is followed by the mean (rounded down) of it and the next; last[i] has no next."""
    wide = pcm.astype(np.int32)
    after = np.append(wide[1:], 0)
    after[last] = wide[last]
    return np.stack([pcm, ((wide + after) >> 1).astype(np.int16)], axis=1).reshape(-1)


def wav(samples: bytes, tag: int, rate: int, width: int) -> bytes:
    """A mono RIFF/WAVE file; other formats than PCM carry the fact chunk."""
    fact = b"" if tag == PCM else b"fact" + struct.pack("<II", 4, len(samples) // width)
    fmt = struct.pack("<HHIIHH", tag, 1, rate, rate * width, width, 8 * width) + (b"" if tag == PCM else b"\0\0")
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + fact + b"data" + struct.pack("<I", len(samples))
    return b"RIFF" + struct.pack("<I", len(body) + len(samples)) + body + samples


def read_wav(media: bytes) -> tuple[int, int, memoryview]:
    """Format tag, rate and sample bytes of a file made by any writer of plain chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, tag, rate = 12, None, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", media, at + 8)
        elif name == b"data" and tag is not None:
            return tag, rate, memoryview(media)[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no samples")


def payload(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw + bytes([PAD]) * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw))


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
    ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()),
])
MEDIA = pa.schema([("media", pa.binary()), ("resampled", pa.binary())])


def _store(batches: Iterator[pa.RecordBatch], keep_media: bool) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, limit=SLICE_BYTES):
        offsets, data = text_bytes(batch.column("text"))
        sizes = np.diff(offsets)
        files = []
        for i, n in enumerate(sizes):
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            files.append(wav(raw + bytes([PAD]) * (max(FRAME, -(-int(n) // FRAME) * FRAME) - int(n)), MU_LAW, RATE, 1))
        read = [bytes(read_wav(f)[2]) for f in files]  # from here on only what was stored is used
        codes = np.frombuffer(b"".join(read), np.uint8)
        lengths = np.array([len(r) for r in read], np.int64)
        begin = np.cumsum(lengths) - lengths
        mu, a = MU[codes], A[codes]
        high = doubled(mu, begin + lengths - 1)
        adpcm = decode_adpcm(codes.reshape(-1, BLOCK)).reshape(-1)
        per_block = 1 + 2 * (BLOCK - 4)
        wide = mu.astype(np.int64)
        energy = np.add.reduceat(wide * wide, begin)
        peak = np.maximum.reduceat(np.abs(wide), begin)
        sign = mu < 0
        crossed = np.append(sign[1:] != sign[:-1], False)
        crossed[begin + lengths - 1] = False
        crossings = np.add.reduceat(crossed.astype(np.int64), begin)
        a_energy = np.add.reduceat(a.astype(np.int64) ** 2, begin)
        ad_begin = begin // BLOCK * per_block
        ad_level = np.add.reduceat(np.abs(adpcm.astype(np.int64)), ad_begin)
        rows, media = [], []
        for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            b, n = int(begin[i]), int(lengths[i])
            loud = high[2 * b : 2 * (b + n)].tobytes()
            steps = adpcm[b // BLOCK * per_block : (b + n) // BLOCK * per_block].tobytes()
            feature = (
                f"mu:{energy[i]}/{peak[i]}/{crossings[i]} a:{a_energy[i]} adpcm:{ad_level[i]}/{zlib.crc32(steps):08x} pcm16k:{zlib.crc32(loud):08x}"
            )
            rows.append((
                doc_id, int(sizes[i]), n, hashlib.sha256(read[i]).hexdigest(), zlib.crc32(read[i][-32:]), len(files[i]),
                hashlib.sha256(files[i]).hexdigest(), feature,
            ))
            if keep_media:
                media.append((files[i], wav(loud, PCM, 2 * RATE, 2)))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RESULT, strict=True)]
        if keep_media:
            columns += [pa.array(c, pa.binary()) for c in zip(*media, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*RESULT, *MEDIA] if keep_media else [*RESULT]))


def store_as_audio(docs: DataFrame, keep_media: bool = True) -> DataFrame:
    """One row per row of docs (doc_id, text): the text's bytes as mu-law samples in a WAVE file, read back.

    Besides the digests come `media` (the stored file) and `resampled` (its sound as 16 kHz linear PCM, a WAVE
    file too) unless keep_media is false. The feature string has, of the samples read back: energy, peak and
    zero crossings as mu-law; energy as A-law; level and checksum as IMA ADPCM blocks of 36 bytes; checksum of
    the resampled PCM. Only the text decides the values, so equal texts have equal ones.

    A null or empty text is stored as one frame of padding. A null doc_id stays null; repeated rows are stored
    one by one; other columns are not read; an empty table gives no rows. A text is held whole, once a task.
    """
    names = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'binary' if f.type == pa.binary() else 'bigint'}" for f in [*RESULT, *(MEDIA if keep_media else [])])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: _store(batches, keep_media), names
    )
