"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

A text is one sequence in which a space is U+2581. No piece of a merge-type vocabulary has a space after another
character, so merges never cross from one word to the next: each word with the spaces before it is segmented by
itself. Within a word an agenda gives the best merge first, and a keyed hash of (seed, doc_id, place of the word in
the text, place in the word, pair) decides whether that candidate is skipped: every occurrence draws for itself.

Which merge comes next depends only on the word and on what was skipped before. A worker keeps that as a tree for
each word, of the ways that occurrences took so far; all occurrences of a batch go down their trees together, one
choice per step, and a way that nobody took before is worked out by segmenting the occurrence (with numpy, one
choice of each per step). Segmentations are put together from a pool of ids, decoded and compared with the text.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import mixed, released, run_hashes, sliced, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
DROPOUT, SEED = 0.1, 20_240_501
#: Draws of a word that are held against the function segment, one by one; texts draw from 64 bits.
VARIANTS = 4
#: A worker forgets the words it has met when it knows so many, or so many ids or choices of them; with SMALL it keeps
#: half of that, and words are segmented more often.
KNOWN, SMALL = (500_000, 4_000_000), (250_000, 2_000_000)
#: Words of more bytes have no tree when there is dropout: hardly two occurrences would go the same way.
TREE_BYTES = 64
#: Words of up to so many characters are segmented together with those that fit the same width, so many at once.
WIDTHS, ROWS = (9, 13, 20, 40), 8192
#: In place of the way of a skipped candidate, at an end of a tree.
END = -2
PLACE, BASE = 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15
M64 = (1 << 64) - 1


class Vocabulary:
    """Pieces and ranks of a merge-type model with byte fallback, in plain form that travels to the workers."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes_at = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        if len(self.bytes_at) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: -model.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space inside; words can't be segmented one by one")
        self.size = n
        self.raw = [b""] * n
        for i in plain:
            self.raw[i] = self.pieces[i].replace(SPACE, " ").encode()
        for b, i in self.bytes_at.items():
            self.raw[i] = bytes([b])


def scramble(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


def segment(vocabulary: Vocabulary, unit: str, dropout: float = 0.0, seed: int = 0, variant: int = 0, trace: list | None = None) -> list[int]:
    """Piece ids of a word with the spaces before it. A literal U+2581 goes by bytes, so it differs from a space.

    variant is the draw of the occurrence. trace is given the choices: code of the candidate, whether it was skipped.
    """
    symbols: list[str | None] = [" " if c == SPACE else SPACE if c == " " else c for c in unit]  # a literal one can't merge as " " is in no piece
    score, n = vocabulary.score, len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    agenda: list[tuple[float, int, int, str]] = []
    bar, key = int(dropout * (1 << 64)), scramble((seed * BASE + variant + 1) & M64)
    for i in range(n - 1):
        if (rank := score.get(pair := symbols[i] + symbols[i + 1])) is not None:
            agenda.append((rank, i, i + 1, pair))
    heapq.heapify(agenda)
    while agenda:
        rank, i, j, pair = heapq.heappop(agenda)
        if symbols[i] is None or symbols[j] is None or after[i] != j or symbols[i] + symbols[j] != pair:
            continue  # a part has been merged since
        code = (i * PLACE + vocabulary.ids[pair]) & M64
        skipped = bar > 0 and scramble(key ^ code) < bar
        if trace is not None:
            trace.append((code, skipped))
        if skipped:
            continue
        symbols[i], symbols[j] = pair, None
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if (rank := score.get(joined := pair + symbols[k])) is not None:
                heapq.heappush(agenda, (rank, i, k, joined))
        if (h := before[i]) >= 0 and (rank := score.get(joined := symbols[h] + pair)) is not None:
            heapq.heappush(agenda, (rank, h, i, joined))
    out: list[int] = []
    for s in symbols:
        if s is None:
            continue
        if (found := vocabulary.ids.get(s)) is not None:
            out.append(found)
        else:
            out += [vocabulary.bytes_at[b] for b in (SPACE if s == " " else " " if s == SPACE else s).encode("utf-8", "surrogatepass")]
    return out


class Tables:
    """The vocabulary as arrays: ids of characters, merges by pair, ranks, and the bytes of the pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.of_char = np.full(0x110000, -1, np.int32)
        for piece, i in vocabulary.ids.items():
            if len(piece) == 1 and piece != SPACE:
                self.of_char[ord(piece)] = i
        self.of_char[32] = vocabulary.ids[SPACE]
        self.size = vocabulary.size
        merges = sorted(
            (vocabulary.ids[p[:k]] * self.size + vocabulary.ids[p[k:]], i)
            for p, i in vocabulary.ids.items() for k in range(1, len(p)) if p[:k] in vocabulary.ids and p[k:] in vocabulary.ids
        )
        self.pairs, self.merged = np.array([m[0] for m in merges], np.int64), np.array([m[1] for m in merges], np.int64)
        self.rank = np.zeros(self.size)
        for piece, i in vocabulary.ids.items():
            self.rank[i] = vocabulary.score[piece]
        self.raw = np.frombuffer(b"".join(vocabulary.raw), np.uint8)
        self.raw_n = np.array([len(r) for r in vocabulary.raw], np.int64)
        self.raw_at = np.cumsum(self.raw_n) - self.raw_n

    def segment(self, symbols: np.ndarray, keys: np.ndarray, bar: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As the function segment, for all rows of character ids (ended by -1) at once.

        Rows of piece ids, ended by -1; the choices of row after row: codes, and whether skipped; their number in each row.
        """
        n, width = symbols.shape
        start = np.tile(np.arange(width, dtype=np.uint64), (n, 1))

        def candidates(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pair = left.astype(np.int64) * self.size + right
            found = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            good = (self.pairs[found] == pair) & (left >= 0) & (right >= 0)
            merged = self.merged[found]
            return merged, np.where(good, self.rank[merged], np.inf)

        merged, rank = candidates(symbols[:, :-1], symbols[:, 1:])
        rows, columns = np.arange(n), np.arange(width)
        made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            best = rank[rows].argmin(axis=1)
            open_ = rank[rows, best] < np.inf
            rows, best = rows[open_], best[open_]
            if not len(rows):
                of, codes, skips = (np.concatenate(x) for x in zip(*made, strict=True)) if made else (np.zeros(0, k) for k in (np.int64, np.uint64, bool))
                order = np.argsort(of, kind="stable")
                return symbols, codes[order], skips[order], np.bincount(of, minlength=n)
            still = rows
            if bar:
                code = start[rows, best] * np.uint64(PLACE) + merged[rows, best].astype(np.uint64)
                skip = mixed(keys[rows] ^ code) < np.uint64(bar)
                made.append((rows, code, skip))
                rank[rows[skip], best[skip]] = np.inf
                rows, best = rows[~skip], best[~skip]
            symbols[rows, best] = merged[rows, best]
            shift = np.minimum(columns + (columns > best[:, None]), width - 1)
            for x in (symbols, start):
                x[rows] = np.take_along_axis(x[rows], shift, axis=1)
            symbols[rows, width - 1] = -1
            shift = np.minimum(columns[:-1] + (columns[:-1] >= best[:, None]), width - 2)
            for x in (merged, rank):
                x[rows] = np.take_along_axis(x[rows], shift, axis=1)
            rank[rows, width - 2] = np.inf
            for at in (best - 1, best):
                ok = (at >= 0) & (at < width - 1)
                r, c = rows[ok], at[ok]
                merged[r, c], rank[r, c] = candidates(symbols[r, c], symbols[r, c + 1])
            rows = still


def gathered(pool: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """pool[at:at + n] of each, one after the other."""
    return pool[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.room, self.size = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> int:
        """Where the values begin."""
        at, self.size = self.size, self.size + len(values)
        if self.size > len(self.room):
            room = np.empty(max(self.size, 2 * at), self.room.dtype)  # what is not filled yet takes no memory
            room[:at] = self.room[:at]
            self.room = room
        self.room[at : self.size] = values
        return at


class Encoder:
    """Encodes texts; keeps a tree of choices for each word met so far, and their segmentations in a pool of ids.

    A node of a tree is a choice (its code, and the nodes that follow if the candidate is taken or skipped, -1 while
    nobody went there) or an end: the place of its ids in the pool, their number, and END.
    """

    def __init__(self, vocabulary: Vocabulary, dropout: float, seed: int, room: tuple[int, int] = KNOWN):
        self.vocabulary, self.dropout, self.seed, self.tables, self.most = vocabulary, dropout, seed, Tables(vocabulary), room
        self.bar = int(dropout * (1 << 64))
        self.forget()

    def forget(self) -> None:
        self.known, self.roots = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes of words, sorted, and their trees' first nodes
        self.ids, self.code, self.next = Growing(np.int32), Growing(np.uint64), Growing(np.int32)

    @property
    def pool(self) -> np.ndarray:
        return self.ids.room[: self.ids.size]

    def keys(self, draws: np.ndarray) -> np.ndarray:
        """The key of an occurrence, from its draw and the seed."""
        return mixed(draws.astype(np.uint64) + np.uint64((self.seed * BASE + 1) & M64))

    def learn(self, units: list[str], draws: np.ndarray, done: int = 0) -> np.ndarray:
        """Segments occurrences of words; their choices after the first `done`, and ends, become nodes. The first of each."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        keys = self.keys(draws)
        plain = np.zeros(len(units), bool)
        parts, n, order, codes, skips, made = [], [], [], [], [], []
        fits = [(np.flatnonzero((sizes > low) & (sizes <= width)), width) for low, width in zip((0, *WIDTHS), WIDTHS, strict=False)]
        for rows, width in ((rows[i : i + ROWS], width) for rows, width in fits for i in range(0, max(len(rows), 1), ROWS)):
            chars = np.array([units[i] for i in rows], f"U{width}").view(np.uint32).reshape(-1, width)
            ids = np.where(chars > 0, self.tables.of_char[chars], -1)
            good = (ids >= 0).sum(axis=1) == sizes[rows]  # all characters are pieces, none is NUL
            rows = rows[good]
            out, code, skip, choices = self.tables.segment(ids[good], keys[rows], self.bar)
            plain[rows] = True
            for x, y in zip((parts, n, order, codes, skips, made), (out[out >= 0], (out >= 0).sum(axis=1), rows, code, skip, choices), strict=True):
                x.append(y)
        for i in np.flatnonzero(~plain):
            trace: list[tuple[int, bool]] = []
            out = np.array(segment(self.vocabulary, units[i], self.dropout, self.seed, int(draws[i]), trace if self.bar else None), np.int32)
            code, skip = np.array([t[0] for t in trace], np.uint64), np.array([t[1] for t in trace], bool)
            for x, y in zip((parts, n, order, codes, skips, made), (out, [len(out)], [i], code, skip, [len(trace)]), strict=True):
                x.append(y)
        n, order, skips, made = np.concatenate(n), np.concatenate(order), np.concatenate(skips), np.concatenate(made).astype(np.int64)
        at = self.ids.add(np.concatenate(parts)) + np.cumsum(n) - n
        kept = np.maximum(made - done, 0)
        begin = np.cumsum(made) - made + made - kept  # of the choices that become nodes
        last = np.cumsum(kept + 1) - 1
        total = int(last[-1]) + 1
        end = np.zeros(total, bool)
        end[last] = True
        code, turn = np.zeros(total, np.uint64), np.full((total, 2), -1, np.int32)
        code[last], turn[last, 0], turn[last, 1] = at, n, END
        code[~end] = gathered(np.concatenate(codes), begin, kept)
        base = self.code.add(code)
        inner = np.flatnonzero(~end)
        turn[inner, gathered(skips, begin, kept).astype(np.int64)] = base + inner + 1
        self.next.add(turn.ravel())
        first = np.zeros(len(units), np.int64)
        first[order] = base + last - kept
        return first

    def open_(self, nodes: np.ndarray) -> np.ndarray:
        """Which nodes are choices."""
        return self.next.room[2 * nodes + 1] != END

    def encode(self, data: np.ndarray, offsets: np.ndarray, streams: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that all begin with the space that the model adds, and where each text's ids begin and end."""
        if len(self.known) > self.most[0] or max(self.ids.size, self.code.size) > self.most[1]:
            self.forget()
        first = data == 32
        first[1:] &= data[:-1] != 32
        first[offsets[:-1]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        text = np.searchsorted(offsets, starts, side="right") - 1
        begin = np.searchsorted(starts, offsets)
        hashes = run_hashes(data, starts, ends, BASE)
        draws = np.zeros(len(starts), np.uint64)
        if self.bar:
            stream = np.array([scramble((s ^ self.seed) & M64) for s in streams], np.uint64)
            draws = mixed((np.arange(len(starts)) - begin[text]).astype(np.uint64) * np.uint64(BASE) + stream[text])
        single = (ends - starts > TREE_BYTES) if self.bar else np.zeros(len(starts), bool)  # segmented one by one
        raw = data.tobytes()
        words = lambda at: [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        node = np.zeros(len(starts), np.int64)
        distinct, where, which = np.unique(hashes[~single], return_index=True, return_inverse=True)
        where = np.flatnonzero(~single)[where]
        at = np.searchsorted(self.known, distinct)
        met = at < len(self.known)
        met[met] = self.known[at[met]] == distinct[met]
        roots = np.zeros(len(distinct), np.int64)
        roots[met] = self.roots[at[met]]
        new = np.flatnonzero(~met)
        if len(new):
            roots[new] = self.learn(words(where[new]), draws[where[new]])
            self.known, self.roots = np.insert(self.known, at[new], distinct[new]), np.insert(self.roots, at[new], roots[new])
        node[~single] = roots[which]
        if single.any():
            at = np.flatnonzero(single)
            node[at] = self.learn(words(at), draws[at], 1 << 60)
        keys, done = self.keys(draws), 0
        active = np.flatnonzero(self.open_(node))
        while len(active):
            skip = mixed(keys[active] ^ self.code.room[node[active]]) < np.uint64(self.bar)
            turn, done = 2 * node[active] + skip, done + 1
            after = self.next.room[turn].astype(np.int64)
            if len(lost := np.flatnonzero(after < 0)):
                way, one = np.unique(turn[lost], return_index=True)
                at = active[lost[one]]
                found = self.learn(words(at), draws[at], done)
                self.next.room[way] = found
                after[lost] = self.next.room[turn[lost]]
            node[active] = after
            active = active[self.open_(after)]
        n = self.next.room[2 * node].astype(np.int64)
        return gathered(self.pool, self.code.room[node].astype(np.int64), n), np.append(0, np.cumsum(n))[begin]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """UTF-8 bytes of ids; those of a text begin with the space that encoding added."""
        return gathered(self.tables.raw, self.tables.raw_at[ids], self.tables.raw_n[ids])


def encode_text(encoder: Encoder, text: str, stream: int = 0) -> np.ndarray:
    """Ids of one text; none for an empty one."""
    data = np.frombuffer((" " + text).encode(), np.uint8)
    return encoder.encode(data, np.array([0, len(data)]), [stream])[0] if text else np.zeros(0, np.int32)


def decode_ids(encoder: Encoder, ids: np.ndarray) -> str:
    return encoder.decode(ids)[1:].tobytes().decode()


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, dropout: float, seed: int, keep_ids: bool, room: tuple[int, int] = KNOWN) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary, dropout, seed, room)
    for batch in sliced(batches):
        doc_ids = batch.column("doc_id").to_pylist()
        offsets, raw = text_bytes(batch.column("text"))
        sizes = np.diff(offsets)
        some = np.flatnonzero(sizes)  # an empty text has no ids, not even that of the added space
        data = np.full(int(sizes.sum()) + len(some), 32, np.uint8)
        begin = np.append(0, np.cumsum(sizes[some] + 1))
        body = np.ones(len(data), bool)
        body[begin[:-1]] = False
        data[body] = raw
        ids, at = encoder.encode(data, begin, [doc_ids[i] or 0 for i in some]) if len(some) else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        back = encoder.decode(ids)
        back_at = np.append(0, np.cumsum(encoder.tables.raw_n[ids]))[at]
        n_ids, bounds = np.zeros(len(sizes), np.int64), np.zeros((len(sizes), 4), np.int64)
        n_ids[some] = np.diff(at)
        bounds[some] = np.stack([at[:-1], at[1:], back_at[:-1] + 1, back_at[1:]], axis=1)
        id_bytes, back_bytes, raw_bytes = ids.astype("<i4").tobytes(), back.tobytes(), raw.tobytes()
        rows = []
        for i, doc_id in enumerate(doc_ids):
            a, b, c, d = bounds[i].tolist()
            text = back_bytes[c:d]
            rows.append((
                doc_id, b - a, hashlib.sha256(id_bytes[4 * a : 4 * b]).hexdigest(), hashlib.sha256(text).hexdigest(),
                text == raw_bytes[offsets[i] : offsets[i + 1]],
            ))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "lossless"]
        if keep_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def encode(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED, keep_ids: bool = True, room: tuple[int, int] = KNOWN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of 32-bit little-endian ids), decoded_sha256, lossless and, if kept, ids.

    The text of every row of docs is encoded whole and its ids are decoded again; lossless says that the bytes
    came back. Each occurrence of a word draws by (seed, doc_id, place), so a run repeats exactly at any partitioning, and with
    dropout 0 ids are those of the model's own encoder. A null or empty text has no ids (and is lossless); a null
    doc_id counts as 0 for the draw and stays null; repeated rows are encoded one by one; other columns are not
    read. The model file is read on the driver only. room bounds what a worker keeps of the words it has met.
    """
    vocabulary = Vocabulary(model)
    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, lossless boolean"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: released(_encode(b, vocabulary, dropout, seed, keep_ids, room)), kinds + (", ids array<int>" if keep_ids else ""))
