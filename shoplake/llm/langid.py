"""Language identification by a linear-chain conditional random field over words.

Every word is labelled with a language. Emissions add the weights of hashed affixes and byte n-grams and of a lexicon learned
from the sample; transitions say how readily the language changes from one word to the next. Forward-backward gives each word's
marginals, so a text that switches languages is labelled word by word; its language is the one with the largest mean.

The field is trained on the driver on a sample of bounded size; prediction runs over whole texts in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplake.llm.common import BYTE_CODES, joined, mapped, runs, slices, spans_hash, text_key, texts_of
from shoplake.llm.decontaminate import lowered

#: Bounds of the sample: documents of each language, of all (but ``LEAST_EACH`` of each anyway), and characters that are read of one.
DOCS_EACH = 250
DOCS = 12_500
LEAST_EACH = 20
SAMPLE_CHARS = 20_000
#: With more languages than this, texts are predicted in smaller batches, as a block takes their number squared.
MANY = 50

BUCKETS = 1 << 15
LEXICON_LEAST = 5  # occurrences in the sample
LENGTH = 64  # words of a training sequence, made of stretches of several documents
STRETCH = 24
EPOCHS = 3
RATE = 0.3
DECAY = 1e-6
BLOCK = 32
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

#: Affix features: from the front or the back, and bytes.
AFFIXES = (("front", 2), ("front", 3), ("front", 4), ("back", 2), ("back", 3), ("back", 4))


class Words:
    """The words of many texts: text number of each, and the distinct words' features."""

    def __init__(self, texts: list[bytes]):
        data, offsets = joined(texts)
        start, end = runs(_LETTER[data])
        self.of = np.searchsorted(offsets, start, side="right") - 1
        small = lowered(data)
        codes = BYTE_CODES[small]
        hashes = spans_hash(codes, start, end)
        # Texts repeat their words: features are made once for each distinct one.
        self.hashes, first, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        start, end = start[first], end[first]
        self.affixes = []
        for k, (side, size) in enumerate(AFFIXES):
            a = start if side == "front" else np.maximum(start, end - size)
            b = np.minimum(end, start + size) if side == "front" else end
            self.affixes.append(self._bucket(spans_hash(codes, a, b), k))
        # Byte trigrams with the word's edges: those that begin one before it to those that end one after it.
        self.grams, self.gram_starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(start):
            sizes = end - start
            marked = np.where(_LETTER[data], small, 32)
            at = np.repeat(start - 1, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
            self.grams = self._bucket(self._triples(marked, at), len(AFFIXES))
            self.gram_starts = np.cumsum(sizes) - sizes

    @staticmethod
    def _triples(marked: np.ndarray, at: np.ndarray) -> np.ndarray:
        padded = np.concatenate([[32], marked, [32]]).astype(np.uint64)
        return padded[at + 1] << np.uint64(16) | padded[at + 2] << np.uint64(8) | padded[at + 3]

    @staticmethod
    def _bucket(values: np.ndarray, kind: int) -> np.ndarray:
        mixed = (values + np.uint64(kind + 1)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(49)).astype(np.int64)


@dataclass
class Field:
    """A trained field: ``weights`` (buckets by labels), ``lexicon`` (sorted word hashes) with its weights, ``transitions``."""

    labels: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray

    def listed(self, words: Words) -> np.ndarray:
        """Each distinct word's place in the lexicon, or the last row (of zeros) if it has none."""
        if not len(self.lexicon):
            return np.zeros(len(words.hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, words.hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == words.hashes, at, len(self.lexicon))

    def emissions(self, words: Words) -> np.ndarray:
        """Scores of every distinct word for every label. Trigram weights are averaged, as words differ in length."""
        out = self.lexicon_weights[self.listed(words)].copy()
        for bucket in words.affixes:
            out += self.weights[bucket]
        if len(words.gram_starts):
            sums = np.add.reduceat(self.weights[words.grams], words.gram_starts, axis=0)
            out += sums / np.diff(np.append(words.gram_starts, len(words.grams)))[:, None]
        return out

    def marginals(self, scores: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
        """Each label's mean marginal over the words of each text (forward-backward over all texts at once).

        Texts are cut into blocks of ``BLOCK`` words. Products of a block's matrices carry the messages from block to block, text by
        text; then all blocks are swept side by side.
        """
        k = len(self.labels)
        sizes = np.bincount(of, minlength=n_texts)
        blocks = -(-sizes // BLOCK)
        first_block = np.cumsum(blocks) - blocks
        place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        slot = (first_block[of] + place // BLOCK, place % BLOCK)
        n = int(blocks.sum())
        emit = np.ones((n, BLOCK, k))
        real = np.zeros((n, BLOCK), bool)
        emit[slot] = np.exp(scores - scores.max(axis=1, keepdims=True))
        real[slot] = True
        move = np.exp(self.transitions - self.transitions.max())
        # A text's first word has no transition before it.
        moves = np.broadcast_to(move, (n, k, k)).copy()
        moves[first_block[blocks > 0]] = np.eye(k)
        product = np.broadcast_to(np.eye(k), (n, k, k)).copy()
        for t in range(BLOCK):
            some = real[:, t]
            following = (product[some] @ (move if t else moves[some])) * emit[some, t][:, None, :]
            product[some] = following / following.sum(axis=(1, 2), keepdims=True)
        ahead, behind = np.full((n, k), 1.0 / k), np.full((n, k), 1.0 / k)
        most = int(blocks.max(initial=0))
        order = np.argsort(-blocks, kind="stable")
        left = np.searchsorted(-blocks[order], -np.arange(1, most + 1), side="right")
        for b in range(1, most):
            here = first_block[order[: left[b]]] + b
            reached = np.einsum("ni,nij->nj", ahead[here - 1], product[here - 1])
            ahead[here] = reached / reached.sum(axis=1, keepdims=True)
        for b in range(most - 1, 0, -1):
            here = first_block[order[: left[b]]] + b
            reached = np.einsum("nij,nj->ni", product[here], behind[here])
            behind[here - 1] = reached / reached.sum(axis=1, keepdims=True)
        forward = np.empty((BLOCK, n, k))
        message = ahead
        for t in range(BLOCK):
            following = (message @ move if t else np.einsum("ni,nij->nj", message, moves)) * emit[:, t]
            following /= following.sum(axis=1, keepdims=True)
            message = np.where(real[:, t, None], following, message)
            forward[t] = message
        message, total = behind, np.zeros((n, k))
        for t in range(BLOCK - 1, -1, -1):
            both = forward[t] * message
            total += np.where(real[:, t, None], both / both.sum(axis=1, keepdims=True), 0)
            back = (emit[:, t] * message) @ move.T
            message = np.where(real[:, t, None], back / back.sum(axis=1, keepdims=True), message)
        sums = np.zeros((n_texts, k))
        np.add.at(sums, np.repeat(np.arange(n_texts), blocks), total)
        return sums / np.maximum(sizes, 1)[:, None]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        words = Words([t.encode() for t in texts])
        means = self.marginals(self.emissions(words)[words.word], words.of, len(texts)) if len(words.of) else np.zeros((len(texts), len(self.labels)))
        counts = np.bincount(words.of, minlength=len(texts))
        lettered = [bool(n) and (t.isascii() or any(map(str.isalpha, t))) for n, t in zip(counts, texts, strict=True)]
        best = means.argmax(axis=1)
        languages = [self.labels[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return languages, np.where(lettered, np.clip(means.max(axis=1), 0, 1), 0.0)


# --- training -----------------------------------------------------------------------------------------------------------
def _sequences(words: Words, label_of: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and labels of sequences of LENGTH words, made of shuffled stretches, so that labels change now and then."""
    change = np.flatnonzero(np.concatenate([[True], words.of[1:] != words.of[:-1]]))
    stretches = [np.arange(a, min(a + STRETCH, z)) for s, z in zip(change, np.append(change[1:], len(words.of)), strict=True) for a in range(s, z, STRETCH)]
    rng.shuffle(stretches)
    row = np.concatenate(stretches) if stretches else np.zeros(0, np.int64)
    row = row[: len(row) // LENGTH * LENGTH].reshape(-1, LENGTH)
    return words.word[row], label_of[words.of[row]]


def train(texts: list[str], languages: list[str], seed: int = 5) -> Field:
    """A field fitted by stochastic gradient ascent (AdaGrad) on the sequences' conditional likelihood."""
    labels = sorted(set(languages)) or [UNKNOWN]
    k, rng = len(labels), np.random.default_rng(seed)
    words = Words([t.encode() for t in texts])
    label_of = np.array([labels.index(x) for x in languages], np.int64)
    counts = np.bincount(words.word, minlength=len(words.hashes))
    lexicon = words.hashes[counts >= LEXICON_LEAST]
    field = Field(labels, np.zeros((BUCKETS, k)), lexicon, np.zeros((len(lexicon) + 1, k)), np.zeros((k, k)))
    if k == 1 or not len(words.of):
        return field
    listed = field.listed(words)
    sizes = np.diff(np.append(words.gram_starts, len(words.grams)))
    seen = [np.full_like(x, 1e-3) for x in (field.weights, field.lexicon_weights, field.transitions)]
    for _ in range(EPOCHS):
        row, gold = _sequences(words, label_of, rng)
        for at in range(0, len(row), 128):
            word, label = row[at : at + 128], gold[at : at + 128]
            used, inverse = np.unique(word, return_inverse=True)
            scores = field.lexicon_weights[listed[used]].copy()
            for bucket in words.affixes:
                scores += field.weights[bucket[used]]
            spans = np.repeat(words.gram_starts[used], sizes[used]) + np.arange(sizes[used].sum()) - np.repeat(np.cumsum(sizes[used]) - sizes[used], sizes[used])
            own = np.repeat(np.arange(len(used)), sizes[used])
            share = 1.0 / sizes[used][own]
            scores += np.stack([np.bincount(own, field.weights[words.grams[spans], c] * share, len(used)) for c in range(k)], axis=1)
            slope, moved = _slope(scores[inverse.reshape(word.shape)], label, field.transitions)
            each = np.stack([np.bincount(inverse.ravel(), slope[..., c].ravel(), len(used)) for c in range(k)], axis=1)
            step = np.zeros_like(field.weights)
            for c in range(k):
                for bucket in words.affixes:
                    step[:, c] += np.bincount(bucket[used], each[:, c], BUCKETS)
                step[:, c] += np.bincount(words.grams[spans], each[own, c] * share, BUCKETS)
            known = np.stack([np.bincount(listed[used], each[:, c], len(lexicon) + 1) for c in range(k)], axis=1)
            known[-1] = 0  # words outside the lexicon
            for values, change, past in zip((field.weights, field.lexicon_weights, field.transitions), (step, known, moved), seen, strict=True):
                change = change - DECAY * values * len(word)
                past += change * change
                values += RATE * change / np.sqrt(past)
    field.weights, field.lexicon_weights = field.weights.astype(np.float32), field.lexicon_weights.astype(np.float32)
    return field


def _slope(scores: np.ndarray, gold: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The likelihood's gradient by emission scores and by transitions, for sequences of one length."""
    n, length, k = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    ahead, behind = np.empty((length, n, k)), np.empty((length, n, k))
    ahead[0] = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        x = (ahead[t - 1] @ move) * emit[:, t]
        ahead[t] = x / x.sum(axis=1, keepdims=True)
    behind[-1] = 1.0 / k
    for t in range(length - 1, 0, -1):
        x = (emit[:, t] * behind[t]) @ move.T
        behind[t - 1] = x / x.sum(axis=1, keepdims=True)
    node = ahead * behind
    node /= node.sum(axis=2, keepdims=True)
    slope = -node.transpose(1, 0, 2)
    slope[np.arange(n)[:, None], np.arange(length), gold] += 1
    moved = np.zeros((k, k))
    for t in range(1, length):  # one place at a time: memory for the pairs of labels of one word only
        edge = ahead[t - 1, :, :, None] * move * (emit[:, t] * behind[t])[:, None, :]
        moved -= (edge / edge.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    np.add.at(moved, (gold[:, :-1], gold[:, 1:]), 1)
    return slope, moved


# --- Spark --------------------------------------------------------------------------------------------------------------
def held_out(doc_id: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    """Rows whose labels are not learned from; FALSE where the doc_id is NULL (those are not learned from either)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def fit(docs: DataFrame, docs_each: int = DOCS_EACH) -> Field:
    """Train on about ``docs_each`` documents of each language, picked by a hash, that are not held out; fewer of each with very many languages.

    Every language that has such a document is a label. Rows without text, lang or doc_id are not sampled. Of long texts the first
    ``SAMPLE_CHARS`` characters are read.
    """
    usable = docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy(F.col("lang").cast("string").alias("lang")).count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return train([], [])
    docs_each = min(docs_each, max(LEAST_EACH, DOCS // len(counts)))
    space = 1 << 30
    most = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(space, space * docs_each // r["count"])))])
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(space))
    rows = usable.filter(place < most[F.col("lang").cast("string")]).select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"), F.col("lang").cast("string").alias("lang")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def _batches(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    less = max(1.0, len(field.labels) / MANY) ** 2
    return slices(batches, max(1, int(256 / less)), int((4 << 20) / less))


def _predicted(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    for batch in _batches(batches, field):
        languages, score = field.predict(texts_of(batch))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (0, 2, 3)), pa.array(languages, pa.string()), pa.array(score)], ["doc_id", "tie", "held_out", "lang_pred", "score"])


def predict(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, tie (a hash of the text), held_out, lang_pred and score (the language's mean marginal) of every row of ``docs``.

    Only doc_id and text are read. A NULL text, and one without a letter, is ``und`` with score 0. Repeated rows each come back. An
    empty table gives no rows; a field trained on nothing predicts ``und``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("tie"), held_out().alias("held_out"))
    return mapped(rows, lambda b: _predicted(b, field), "doc_id long, tie long, held_out boolean, lang_pred string, score double")


#: A document whose best language has less than this mean marginal is a mixture without a language.
LEAST_SCORE = 0.4


def with_language(docs: DataFrame, field: Field, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that have a language: neither ``und`` nor below ``least``."""
    row = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, field):
            languages, score = field.predict(texts_of(batch))
            kept = pa.array((score >= least) & np.array([x != UNKNOWN for x in languages]))
            yield batch.select([0]).filter(kept)

    return mapped(row, keep, StructType([row.schema["row"]])).select("row.*")
