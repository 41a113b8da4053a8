"""Language of every word of code-switched text, by a linear-chain conditional random field, and of the document.

A word's emission scores sum learned weights of its affixes, character n-grams, its identity and the languages
whose lexicon has it; learned transitions join neighbours; forward-backward gives each word's marginals. A worker
keeps the emission scores of the words it has met (a bounded table), so that a frequent word is scored once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import give_back, held_out, released, sliced

#: A run of letters; a longer one is cut into consecutive pieces, each of them a place of the chain. None is read in part.
WORD = re.compile(r"[^\W\d_]{1,64}")
UNKNOWN = "und"
#: Words that are worked on at once in one row; a longer text is a run of such pieces, and messages pass from one to the
#: next, so that the whole text is one chain.
CHAIN = 128
#: Places after which products of a piece are scaled anew.
RESCALE = 8
#: Learned from: at most so many documents (those with the smallest hash of doc_id), two spans of SPAN words of each.
SAMPLE, SPAN = 4000, 24
HASH = 1 << 16
#: A worker's table of known words is emptied when it has so many.
KNOWN_WORDS = 300_000


def word_features(word: str) -> list[int]:
    """Hashed prefixes and suffixes to three characters, n-grams to three within marked ends, and the word."""
    marked = f"<{word}>"
    parts = [f"p{word[:n]}" for n in (1, 2, 3)] + [f"s{word[-n:]}" for n in (1, 2, 3)] + ["w" + word]
    for n in (1, 2, 3):
        parts += [marked[i : i + n] for i in range(len(marked) - n + 1)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % HASH for p in parts]


class Model:
    """Weights of hashed features (one column a language), of lexicon membership, and of transitions."""

    def __init__(self, langs: list[str]):
        k = len(langs)
        self.langs, self.weights = langs, np.zeros((HASH, k), np.float32)
        self.step, self.lexicon, self.lexicon_weight = np.zeros((k, k)), {}, np.zeros((k, k))

    def emission(self, word: str) -> np.ndarray:
        found = self.weights[word_features(word)].sum(axis=0)
        return found + self.lexicon_weight[lang] if (lang := self.lexicon.get(word)) is not None else found


def messages(emission: np.ndarray, lengths: np.ndarray, before: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What reaches each piece from the pieces before and behind it in its text, for forward_backward.

    Pieces are sorted by falling length; before is the piece that a piece follows, or -1. Each piece that has a
    neighbour is multiplied out to one matrix, all of them at once; along a text there is then a step a piece.
    """
    n, _, k = emission.shape
    start, end = np.ones((n, k)), np.ones((n, k))
    follows = before >= 0
    joined = follows.copy()
    joined[before[follows]] = True
    some = np.flatnonzero(joined)
    if not len(some):
        return start, end
    move, part = np.exp(step), emission[some]
    local = np.exp(part - part.max(axis=2, keepdims=True))
    whole = local[:, 0, :, None] * np.eye(k)
    for t in range(1, int(lengths[some[0]])):
        m = int(np.searchsorted(-lengths[some], -t, side="left"))
        whole[:m] = (whole[:m].reshape(-1, k) @ move).reshape(m, k, k) * local[:m, t, None, :]
        if t % RESCALE == 0:
            whole[:m] /= whole[:m].max(axis=(1, 2), keepdims=True)
    whole /= whole.max(axis=(1, 2), keepdims=True)
    of = np.full(n, -1)
    of[some] = np.arange(len(some))
    rounds, now = [], np.flatnonzero(joined & ~follows)
    behind = np.full(n, -1)
    behind[before[follows]] = np.flatnonzero(follows)
    while len(now := behind[now][behind[now] >= 0]):
        rounds.append(now)
    for now in rounds:
        out = np.einsum("ni,nij->nj", start[before[now]], whole[of[before[now]]]) @ move
        start[now] = out * (k / out.sum(axis=1, keepdims=True))
    for now in reversed(rounds):
        out = np.einsum("nij,nj->ni", whole[of[now]], end[now]) @ move.T
        end[before[now]] = out * (k / out.sum(axis=1, keepdims=True))
    return start, end


def forward_backward(emission: np.ndarray, lengths: np.ndarray, step: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (chains, places, languages) and expected transitions of chains sorted by falling length.

    start and end are messages from what is before and behind a chain; without them a chain stands alone.
    """
    n, places, k = emission.shape
    local = np.exp(emission - emission.max(axis=2, keepdims=True))
    move = np.exp(step)
    ahead, behind = np.zeros_like(local), np.ones_like(local)
    scale = np.ones((n, places))
    active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(places)]  # chains longer than t
    ahead[:, 0] = local[:, 0] if start is None else local[:, 0] * start
    if end is not None:
        behind[np.arange(n), lengths - 1] = end
    for t in range(places):
        m = active[t]
        if t:
            ahead[:m, t] = (ahead[:m, t - 1] @ move) * local[:m, t]
        scale[:m, t] = ahead[:m, t].sum(axis=1)
        ahead[:m, t] /= scale[:m, t, None]
    for t in range(places - 2, -1, -1):
        m = active[t + 1]
        behind[:m, t] = ((behind[:m, t + 1] * local[:m, t + 1]) @ move.T) / scale[:m, t + 1, None]
    both = ahead * behind
    both /= np.maximum(both.sum(axis=2, keepdims=True), 1e-300)
    moved = np.zeros((k, k))
    for t in range(places - 1):
        m = active[t + 1]
        if m:
            moved += (ahead[:m, t].T @ (behind[:m, t + 1] * local[:m, t + 1] / scale[:m, t + 1, None])) * move
    return both, moved


def train(spans: list[tuple[str, str]], epochs: int = 12, rate: float = 0.3, seed: int = 7) -> Model:
    """A model from (language, words joined by spaces) spans; spans are chained two and two, so languages switch."""
    model = Model(sorted({lang for lang, _ in spans}))
    k, code = len(model.langs), {lang: i for i, lang in enumerate(model.langs)}
    random = np.random.default_rng(seed)
    counts: dict[str, np.ndarray] = {}
    for lang, text in spans:
        for w in text.split(" "):
            counts.setdefault(w, np.zeros(k, np.int32))[code[lang]] += 1
    model.lexicon = {w: int(c.argmax()) for w, c in counts.items() if c.sum() >= 5 and c.max() >= 0.8 * c.sum()}
    known = {w: np.array(word_features(w)) for w in counts}
    mean_w, mean_l, mean_s = np.full((HASH, k), 1e-8), np.full((k, k), 1e-8), np.full((k, k), 1e-8)
    for _ in range(epochs):
        order = random.permutation(len(spans))
        for begin in range(0, len(order), 128):
            part = order[begin : begin + 128]
            chains = [part[i : i + 2] for i in range(0, len(part), 2)]
            words = [[w for j in c for w in spans[j][1].split(" ")] for c in chains]
            truth = [[code[spans[j][0]] for j in c for _ in spans[j][1].split(" ")] for c in chains]
            by_length = sorted(range(len(words)), key=lambda i: -len(words[i]))
            words, truth = [words[i] for i in by_length], [truth[i] for i in by_length]
            lengths = np.array([len(w) for w in words])
            row = np.repeat(np.arange(len(words)), lengths)
            place = np.concatenate([np.arange(n) for n in lengths])
            flat, labels = [w for ws in words for w in ws], np.array([y for ys in truth for y in ys])
            sizes = np.array([len(known[w]) for w in flat])
            at = np.concatenate([known[w] for w in flat])
            of = np.repeat(np.arange(len(flat)), sizes)
            lex = np.array([model.lexicon.get(w, -1) for w in flat])
            local = np.add.reduceat(model.weights[at], np.cumsum(sizes) - sizes, axis=0) + np.where(lex[:, None] >= 0, model.lexicon_weight[lex], 0)
            emission = np.zeros((len(words), lengths[0], k))
            emission[row, place] = local
            both, moved = forward_backward(emission, lengths, model.step)
            wrong = both[row, place]
            wrong[np.arange(len(flat)), labels] -= 1
            wrong /= len(words)
            touched, slot = np.unique(at, return_inverse=True)
            g = np.stack([np.bincount(slot, wrong[of, c], len(touched)) for c in range(k)], axis=1) + 1e-5 * model.weights[touched]
            mean_w[touched] += g * g
            model.weights[touched] -= rate * g / np.sqrt(mean_w[touched])
            g = np.stack([wrong[lex == c].sum(axis=0) for c in range(k)]) + 1e-4 * model.lexicon_weight
            mean_l += g * g
            model.lexicon_weight -= rate * g / np.sqrt(mean_l)
            same = row[1:] == row[:-1]
            seen = np.zeros((k, k))
            np.add.at(seen, (labels[:-1][same], labels[1:][same]), 1)
            g = (moved - seen) / len(words) + 1e-4 * model.step
            mean_s += g * g
            model.step -= rate * g / np.sqrt(mean_s)
    return model


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = []
        for place, lang, text in zip(*(batch.column(c).to_pylist() for c in ("place", "lang", "text")), strict=True):
            words = WORD.findall(text.lower())
            starts = {(place >> 8) % max(1, len(words) - SPAN + 1), (place >> 24) % max(1, len(words) - SPAN + 1)}
            rows += [(place, i, lang, " ".join(words[i : i + SPAN])) for i in sorted(starts) if words]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["place", "at", "lang", "words"]
        )


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from documents that have a language and are not held out; None if there are none with a word."""
    id_ = F.col("doc_id").cast("bigint")
    known = docs.select(id_.alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.select(F.abs(F.xxhash64("doc_id")).alias("place"), "doc_id").distinct().orderBy("place", "doc_id").limit(sample)
    spans = (
        known.join(F.broadcast(chosen), "doc_id").select("place", "lang", "text")
        .mapInArrow(_spans, "place bigint, at bigint, lang string, words string").toArrow().to_pylist()
    )
    spans = sorted({(r["place"], r["at"], r["lang"], r["words"]) for r in spans})
    model = train([(lang, words) for _, _, lang, words in spans]) if spans else None
    give_back()
    return model


class Tagger:
    """Scores texts; keeps the emissions of words met so far."""

    def __init__(self, model: Model):
        self.model, self.ids, self.table = model, {}, np.zeros((1024, len(model.langs)))

    def look_up(self, words: list[str]) -> np.ndarray:
        """A row of the table for each word; -1 for one without a letter."""
        if len(self.ids) > KNOWN_WORDS:
            self.ids = {}
        ids = self.ids
        out = [ids.get(w) for w in words]
        if None in out:
            for i in [i for i, x in enumerate(out) if x is None]:
                w = words[i]
                if (x := ids.get(w)) is None:
                    x = -1
                    if any(map(str.isalpha, w)):
                        x = self.used = getattr(self, "used", -1) + 1 if ids else 0
                        if x >= len(self.table):
                            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                        self.table[x] = self.model.emission(w)
                    ids[w] = x
                out[i] = x
        return np.array(out, np.int64)

    def marginals(self, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all words with a letter in the texts: index of the text, number of characters, marginals."""
        words = [w for ws in found for w in ws]
        text = np.repeat(np.arange(len(found)), [len(ws) for ws in found])
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.look_up(words) if words else np.zeros(0, np.int64)
        keep = ids >= 0
        text, size, ids = text[keep], size[keep], ids[keep]
        if not len(ids):
            return text, size, np.zeros((0, len(self.model.langs)))
        count = np.bincount(text, minlength=len(found))
        within = np.arange(len(text)) - (np.cumsum(count) - count)[text]
        place = within % CHAIN
        chain = np.cumsum(place == 0) - 1
        lengths = np.bincount(chain)
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        emission = np.zeros((len(order), lengths.max(), self.table.shape[1]))
        emission[rank[chain], place] = self.table[ids]
        of = text[place == 0]
        before = np.full(len(order), -1)
        later = np.flatnonzero(of[1:] == of[:-1]) + 1
        before[rank[later]] = rank[later - 1]
        both, _ = forward_backward(emission, lengths[order], self.model.step, *messages(emission, lengths[order], before, self.model.step))
        return text, size, both[rank[chain], place]


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    tagger = Tagger(model) if model else None
    for batch in sliced(batches):
        found = [WORD.findall(t.lower()) for t in batch.column("text").to_pylist()]
        n = batch.num_rows
        if tagger:
            text, size, both = tagger.marginals(found)
            share = np.stack([np.bincount(text, both[:, c] * size, n) for c in range(both.shape[1])], axis=1)
            total, best = share.sum(axis=1), share.argmax(axis=1)
            score = np.where(total > 0, share.max(axis=1) / np.maximum(total, 1e-300), 0.0)
            langs = [model.langs[b] if x > 0 else UNKNOWN for b, x in zip(best, total, strict=True)]
            words = np.bincount(text, minlength=n)
        else:
            score, langs, words = np.zeros(n), [UNKNOWN] * n, np.zeros(n, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(words, pa.int64())],
            names=["doc_id", "held_out", "lang_pred", "score", "n_words"],
        )


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_words of every row of docs, by its whole text.

    The document's language has the largest share of the words' marginals, weighted by characters; score is that
    share, so that code-switched text scores low. Null texts, texts without a letter, and all texts when there is
    nothing to learn from, are `und` with score 0. Learns only from rows with a non-null language and id that are
    not held out, `sample` documents at most. n_words counts the pieces that WORD finds, so a run of letters without
    a space counts once for every 64 of them. Ties go to the language that sorts first. A null doc_id is not held
    out. Repeated rows are judged one by one; of other columns none is read.
    """
    model = fit(docs, sample)
    return _identified(docs, model).select("doc_id", "held_out", "lang_pred", "score", "n_words")


def _identified(docs: DataFrame, model: Model | None) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        lambda b: released(_predict(b, model)), "doc_id bigint, held_out boolean, lang_pred string, score double, n_words bigint"
    )


def _keep(batches: Iterator[pa.RecordBatch], model: Model | None, least: float) -> Iterator[pa.RecordBatch]:
    tagger = Tagger(model) if model else None
    if tagger is None:
        return
    for batch in batches:
        at = 0
        for part in sliced([batch.select([batch.schema.get_field_index("text")])]):
            judged = next(_judge(part, tagger))
            yield batch.slice(at, part.num_rows).filter(pa.array(judged >= least))
            at += part.num_rows


def _judge(part: pa.RecordBatch, tagger: Tagger) -> Iterator[np.ndarray]:
    text, size, both = tagger.marginals([WORD.findall(t.lower()) for t in part.column("text").to_pylist()])
    share = np.stack([np.bincount(text, both[:, c] * size, part.num_rows) for c in range(both.shape[1])], axis=1)
    total = share.sum(axis=1)
    yield np.where(total > 0, share.max(axis=1) / np.maximum(total, 1e-300), -1.0)


def keep_identified(docs: DataFrame, least: float = 0.0, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that identify() does not call `und`; all columns as they are. Code-switched texts stay.

    With a `least`, one language must also have that share of the characters. Nothing stays if there is nothing to
    learn from.
    """
    model = fit(docs, sample)
    return docs.mapInArrow(lambda b: released(_keep(b, model, least)), docs.schema)
