"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are whole words and word beginnings, so inflected forms share a term. All terms of the examples count; their weight is the inverse
document frequency over all documents times what the label says about them. The labelled examples are an inverted index whose postings lie in
blocks of examples; each block
knows the largest weight of each term in it, which bounds every cosine in the block. A query visits blocks in the order of their
bounds and stops once none can hold a nearer example than the ``NEAREST`` it has: the neighbours are exact. Their votes,
weighted by similarity and by the label's sampling rate, are calibrated on the examples themselves, each left out in turn.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import BYTE_CODES, joined, mapped, runs, slices, spans_hash, text_key, texts_of
from shoplake.llm.decontaminate import lowered
from shoplake.llm.langid import _LETTER, held_out

#: Bounds of the labelled sample: documents of each label, and characters of a sampled document.
EXAMPLES_EACH = 2000
SAMPLE_CHARS = 20_000

BEGINNINGS = (4, 5)  # bytes of a word's beginning that are a term
HALF = 24.0  # chi-squared of a term and the label at which the term has a quarter of the greatest weight
LEAST_WEIGHT = 0.05  # of a term that says nothing about the label, next to one that says all
BLOCK = 32
FREQUENT = 1 / 32  # share of the examples from which on a term's postings are a row with a place for each example
MOST_ROWS = 3072  # but only the most frequent so many terms; the others' postings stay in blocks, and the result is the same
FIRST_BLOCKS = 6  # visited at once where frequent terms say nothing; what they give bounds the rest
HAIR = 1e-5  # above a bound, for rounding
NEAREST = 15
PRIOR = 0.3  # pseudo-votes at the base rate, so that few far neighbours say little
DECISION = 0.3
TOGETHER = 512  # texts whose frequent terms are looked up together
SOME = 100  # texts of the sample that are taken apart at a time
SLOTS = 20  # bits of a hash that terms are looked up by


# --- terms --------------------------------------------------------------------------------------------------------------
def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every term occurrence."""
    data, offsets = joined(texts)
    start, end = runs(_LETTER[data])
    codes = BYTE_CODES[lowered(data)]
    of = np.searchsorted(offsets, start, side="right") - 1
    long = [np.flatnonzero(end - start > size) for size in BEGINNINGS]
    # Whole words and beginnings are hashed in one go, so that the sums over the bytes are made once.
    starts = np.concatenate([start, *(start[at] for at in long)])
    ends = np.concatenate([end, *(start[at] + size for at, size in zip(long, BEGINNINGS, strict=True))])
    sizes = np.repeat(np.array([0, *BEGINNINGS], np.uint64), [len(start), *map(len, long)])
    return np.concatenate([of, *(of[at] for at in long)]), spans_hash(codes, starts, ends) + sizes


@dataclass
class Vocabulary:
    hashes: np.ndarray  # sorted
    factor: np.ndarray  # of each term: inverse document frequency times what the label says about it

    def __post_init__(self) -> None:
        # Where the hashes that begin with each ``SLOTS`` bits lie: few each, as hashes are spread evenly.
        held = np.bincount(self._slot(self.hashes), minlength=1 << SLOTS)
        self.first = np.concatenate([[0], np.cumsum(held)]).astype(np.int32)

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - SLOTS)).astype(np.int64)

    def terms(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are terms, and their term numbers."""
        slot = self._slot(hashes)
        term, end = self.first[slot], self.first[slot + 1]
        left = np.flatnonzero(term < end)
        while len(left):
            left = left[self.hashes[term[left]] != hashes[left]]
            term[left] += 1
            left = left[term[left] < end[left]]
        known = np.flatnonzero(term < end)
        return known, term[known].astype(np.int64)

    def vectors_of_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``vectors`` of many texts, some at a time, so that no more than the entries is held for all."""
        parts = [(at, *self.vectors(texts[at : at + SOME])) for at in range(0, len(texts), SOME)]
        return tuple(np.concatenate([p[0] + p[1] if k == 1 else p[k] for p in parts]) for k in (1, 2, 3))

    def vectors(self, texts: list[bytes], weighted: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Non-zero entries of the texts' unit TF-IDF vectors: text, term, weight (or 1); sorted by text and term."""
        of, hashes = term_hashes(texts)
        known, at = self.terms(hashes)
        if not len(known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        key, counts = np.unique(of[known] * len(self.hashes) + at, return_counts=True)
        text, term = key // len(self.hashes), key % len(self.hashes)
        if not weighted:
            return text, term, np.ones(len(text))
        weight = (1.0 + np.log(counts)) * self.factor[term]
        norm = np.sqrt(np.bincount(text, weight * weight, minlength=len(texts)))
        return text, term, weight / norm[text]


def _present(texts: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray]:
    """The terms that occur in each text, once: text number from ``first`` on, and hash."""
    of, hashes = term_hashes(texts)
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])])[: len(of)]
    return (of[new] + first).astype(np.int32), hashes[new]


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All terms of some texts, sorted, and the text and term number of each that a text has."""
    pairs = [_present(texts[at : at + SOME], at) for at in range(0, len(texts), SOME)]
    of, hashes = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    terms, term = np.unique(hashes, return_inverse=True)
    return terms, of, term


def label_weight(of: np.ndarray, term: np.ndarray, n_terms: int, toxic: np.ndarray) -> np.ndarray:
    """What a term says about the label, from ``LEAST_WEIGHT`` to 1; no term is left out.

    By a chi-squared test over the examples, with Yates' correction as most terms are in few, of terms that toxic ones have more often.
    """
    n, n_bad = float(len(toxic)), float(toxic.sum())
    bad, all_of = np.bincount(term, toxic[of], n_terms), np.bincount(term, minlength=n_terms).astype(float)
    ahead = bad * n - all_of * n_bad
    with np.errstate(all="ignore"):
        chi2 = n * np.maximum(ahead - n / 2, 0.0) ** 2 / (all_of * (n - all_of) * n_bad * (n - n_bad))
    chi2 = np.nan_to_num(chi2, posinf=0.0)
    return LEAST_WEIGHT + (1.0 - LEAST_WEIGHT) * (chi2 / (chi2 + HALF)) ** 2


def _ranges(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` numbers from each ``start`` on, one range after the other."""
    end = np.cumsum(counts)
    return np.repeat(start - end + counts, counts) + np.arange(end[-1] if len(end) else 0)


# --- index --------------------------------------------------------------------------------------------------------------
class BlockMaxIndex:
    """Postings of the examples' unit vectors by term, in blocks of ``BLOCK`` examples, with each block's largest weight.

    Terms that a large share of the examples have are full rows, which add up at once for all examples; so their part of a
    block's bound is the largest sum that it really has.
    """

    def __init__(self, text: np.ndarray, term: np.ndarray, weight: np.ndarray, n_texts: int, n_terms: int):
        # Examples that share their weightiest term lie together, so blocks are alike inside and their bounds are tight.
        leading = np.full(n_texts, n_terms)
        by_weight = np.lexsort((weight, text))
        leading[text[by_weight]] = term[by_weight]
        self.order = np.lexsort((np.arange(n_texts), leading))
        self.place = np.empty(n_texts, np.int64)
        self.place[self.order] = np.arange(n_texts)
        self.n_blocks = -(-n_texts // BLOCK)
        at = self.place[text]
        held = np.bincount(term, minlength=n_terms)
        frequent = held >= max(2, FREQUENT * n_texts)
        frequent[np.argsort(-held, kind="stable")[MOST_ROWS:]] = False
        self.row = np.where(frequent, np.cumsum(frequent) - 1, -1).astype(np.int32)
        full = frequent[term]
        self.rows = np.zeros((int(frequent.sum()), self.n_blocks * BLOCK), np.float32)
        self.rows[self.row[term[full]], at[full]] = weight[full]
        at, term, weight = at[~full], term[~full], weight[~full]
        postings = np.lexsort((at, term))
        at, term, self.weight = at[postings], term[postings], weight[postings]
        block = at // BLOCK
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        # Numbers as narrow as they may be: a search reads from all over the index, which so lies nearer to the processor.
        self.at = at.astype(np.min_scalar_type(n_texts))
        self.first = np.append(first, len(term)).astype(np.min_scalar_type(len(term)))  # of each block of a term
        self.block = block[first].astype(np.min_scalar_type(self.n_blocks))
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.blocks_of = np.searchsorted(term[first], np.arange(n_terms + 1))

    def from_rows(self, text: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """What frequent terms add to the cosine of each of ``n`` texts and each example."""
        queries, row = np.zeros((n, len(self.rows)), np.float32), self.row[term]
        queries[text[row >= 0], row[row >= 0]] = weight[row >= 0]
        return (queries @ self.rows).astype(float)

    def nearest_of_all(self, text: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int, without: bool = False) -> Iterator[tuple]:
        """Number and ``nearest`` of each of ``n`` texts, given by the entries of their vectors; ``without``: they are the examples."""
        edges = np.searchsorted(text, np.arange(n + 1))
        for begin in range(0, n, TOGETHER):
            end = min(begin + TOGETHER, n)
            a, b = edges[begin], edges[end]
            sums = self.from_rows(text[a:b] - begin, term[a:b], weight[a:b], end - begin)
            for i in range(begin, end):
                mine = slice(edges[i], edges[i + 1])
                yield i, *self.nearest(term[mine], weight[mine], k, i if without else -1, sums[i - begin])

    def nearest(
        self, term: np.ndarray, weight: np.ndarray, k: int, without: int = -1, frequent: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` nearest examples with a positive cosine (ties: first in the index), the cosines, and the blocks visited.

        ``frequent``: the text's ``from_rows``, where it is known; it is written over.
        """
        cosine = self.from_rows(np.zeros(len(term), np.int64), term, weight, 1)[0] if frequent is None else frequent
        if without >= 0:
            cosine[self.place[without]] = 0.0
        begin, counts = self.blocks_of[term], self.blocks_of[term + 1] - self.blocks_of[term]
        entry, times = _ranges(begin, counts), np.repeat(weight, counts)
        block = self.block.take(entry)
        bound = np.bincount(block, times * self.most.take(entry), self.n_blocks) + cosine.reshape(-1, BLOCK).max(1)
        queue = np.argsort(-bound, kind="stable")
        queue = queue[bound[queue] > 0]
        known, done = np.zeros_like(cosine).reshape(-1, BLOCK), 0
        # No cosine is less than what its frequent terms add, so the k-th largest cosine is at least the k-th largest of these.
        least = float(np.partition(cosine, cosine.size - k)[cosine.size - k]) if cosine.size > k else 0.0
        # Blocks of the highest bounds, then all that may still hold a nearer example; ties with the last one may lie in a block of its bound.
        while done < len(queue) and bound[queue[done]] + HAIR >= least:
            some = queue[done:] if done or least > 0 else queue[:FIRST_BLOCKS]
            some = some[bound[some] + HAIR >= least]
            take = np.zeros(self.n_blocks, bool)
            take[some] = True
            picked = np.flatnonzero(take.take(block))
            start, end = self.first.take(entry[picked]).astype(np.int64), self.first.take(entry[picked] + 1)
            sizes = end - start
            posting = _ranges(start, sizes)
            cosine += np.bincount(self.at.take(posting), np.repeat(times[picked], sizes) * self.weight.take(posting), len(cosine))
            if without >= 0:
                cosine[self.place[without]] = 0.0
            known[some] = cosine.reshape(-1, BLOCK)[some]
            done += len(some)
            # Only places in visited blocks can hold one of the nearest.
            seen = known[queue[:done]].ravel()
            if seen.size > k:
                least = max(least, float(np.partition(seen, seen.size - k)[seen.size - k]))
        known = known.ravel()
        hit = np.flatnonzero((known >= least) & (known > 0))
        hit = hit[np.lexsort((hit, -known[hit]))[:k]]
        return self.order[hit], known[hit], done


@dataclass
class Model:
    vocabulary: Vocabulary
    index: BlockMaxIndex
    names: np.ndarray  # doc_id of each example
    toxic: np.ndarray
    rate: np.ndarray
    base: float
    votes: np.ndarray  # calibration: share of votes ...
    chances: np.ndarray  # ... and the chance that goes with it

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        weight = cosine * cosine * self.rate[near]
        pull = PRIOR * float(self.rate.mean())
        return float((weight @ self.toxic[near] + pull * self.base) / (weight.sum() + pull))

    def chance(self, vote: float) -> float:
        return float(np.interp(vote, self.votes, self.chances))

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, float]]]]:
        """Scores, and the neighbours (doc_id and cosine) that gave them."""
        text, term, weight = self.vocabulary.vectors([t.encode() for t in texts])
        out, evidence = np.zeros(len(texts)), []
        for k, near, cosine, _ in self.index.nearest_of_all(text, term, weight, len(texts), NEAREST):
            out[k] = self.chance(self.vote(near, cosine))
            evidence.append([(int(self.names[i]), float(c)) for i, c in zip(near, cosine, strict=True)])
        return out, evidence


def _monotone(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` by weighted squares: neighbours out of order are pooled."""
    pools: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist(), strict=True):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            last = pools.pop()
            total = pools[-1][1] + last[1]
            pools[-1] = [(pools[-1][0] * pools[-1][1] + last[0] * last[1]) / total, total, pools[-1][2] + last[2]]
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.zeros(0)


def train(names: list[int], texts: list[str], toxic: list[int], rate: list[float], counted: Callable[[np.ndarray], tuple[np.ndarray, int]]) -> Model:
    """A model of labelled examples; ``rate``: how many labelled documents each example stands for.

    ``counted`` gives the documents that have each of some terms, and the number of all documents.
    """
    data, bad, rates = [t.encode() for t in texts], np.array(toxic, float), np.array(rate, float)
    if not len(data):
        rates, bad, data, names = np.ones(1), np.zeros(1), [b""], [-1]
    terms, of, term = terms_of(data)
    held, documents = counted(terms)
    vocabulary = Vocabulary(terms, np.log1p(max(documents, 1) / (1.0 + held)) * label_weight(of, term, len(terms), bad))
    text, term, weight = vocabulary.vectors_of_all(data)
    index = BlockMaxIndex(text, term, weight, len(data), len(vocabulary.hashes))
    base = float(rates @ bad / rates.sum())
    made = Model(vocabulary, index, np.array(names), bad, rates, base, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    votes = np.zeros(len(data))
    for k, near, cosine, _ in index.nearest_of_all(text, term, weight, len(data), NEAREST, without=True):
        votes[k] = made.vote(near, cosine)
    order = np.argsort(votes, kind="stable")
    where, group = np.unique(votes[order], return_inverse=True)
    mass = np.bincount(group, rates[order])
    share = _monotone(np.bincount(group, rates[order] * bad[order]) / mass, mass)
    # Half a document each way keeps scores off 0 and 1 and damps steps that few examples make.
    step = np.cumsum(np.concatenate([[0], np.diff(share) > 0]))
    share = ((np.bincount(step, share * mass) + base) / (np.bincount(step, mass) + 1.0))[step]
    made.votes, made.chances = where, np.clip(_monotone(share, mass), 0.0, 1.0)
    return made


# --- Spark --------------------------------------------------------------------------------------------------------------
def _is_held_out(doc_id: str = "doc_id") -> Column:
    return held_out(doc_id, parts=4, part=2)


def _counted(batches: Iterator[pa.RecordBatch], hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How many of a task's texts have each term, and under -1 the number of texts."""
    sums, texts = np.zeros(len(hashes), np.int64), 0
    words = Vocabulary(hashes, np.ones(len(hashes)))
    for batch in slices(batches):
        texts += batch.num_rows
        sums += np.bincount(words.vectors([t.encode() for t in texts_of(batch)], weighted=False)[1], minlength=len(hashes))
    some = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(sums[some], texts))], ["term", "n"])


def _frequencies(docs: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents with each term, and all documents. Tasks add up their own; the result has a row for each term of the sample."""
    sums = mapped(docs.select("text"), lambda b: _counted(b, hashes), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = sums.column("term").to_numpy(), sums.column("n").to_numpy()
    held = np.zeros(len(hashes), np.int64)
    held[term[term >= 0]] = n[term >= 0]
    return held, int(n[term < 0].sum())


def fit(docs: DataFrame, labels: DataFrame, examples_each: int = EXAMPLES_EACH) -> Model:
    """Learn from about ``examples_each`` labelled documents of each label, picked by a hash, that are not held out.

    ``labels`` needs doc_id and toxic (0 or 1); rows with NULL in either, or that contradict each other, are not used, nor
    are texts that are NULL or over ``SAMPLE_CHARS`` characters. Of equal texts the first by doc_id counts. How many documents
    have a term is counted over all rows of ``docs``.
    """
    clear = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~_is_held_out())
    clear = clear.groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.min("toxic").alias("_toxic"), F.max("toxic").alias("_most")).filter("_toxic = _most")
    sizes = {r["_toxic"]: r["count"] for r in clear.groupBy("_toxic").count().collect()}
    space = 1 << 30
    most = [min(space, space * examples_each // max(1, sizes.get(t, 1))) for t in (0, 1)]
    picked = clear.filter(F.pmod(F.xxhash64("_doc"), F.lit(space)) < F.when(F.col("_toxic") == 1, most[1]).otherwise(most[0])).select("_doc", "_toxic")
    usable = docs.filter(F.char_length("text") <= SAMPLE_CHARS).select(F.col("doc_id").cast("long").alias("_doc"), "text")
    found_rows = sorted((r["_doc"], r["text"], r["_toxic"]) for r in usable.join(F.broadcast(picked), "_doc").select("_doc", "text", "_toxic").collect())
    # The picked numbers are few by construction, so the texts are filtered where they are read, without a shuffle.
    # Copies of one text are one example, so that a group of them does not make all its words telling.
    once: dict[str, tuple[int, str, int]] = {}
    for row in found_rows:
        once.setdefault(row[1], row)
    rows = sorted(once.values())
    found = [max(1, sum(r[2] == t for r in rows)) for t in (0, 1)]
    rates = [sizes.get(r[2], 1) / found[r[2]] for r in rows]
    return train([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], rates, lambda terms: _frequencies(docs, terms))


SCORED = "doc_id long, tie long, held_out boolean, score double, predicted int, evidence array<struct<doc_id:long,cosine:double>>"


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))
    for batch in slices(batches, TOGETHER):
        texts = texts_of(batch)
        # Copies in a batch are scored once.
        number = {t: i for i, t in enumerate(dict.fromkeys(texts))}
        once, found = model.score(list(number))
        places = [number[t] for t in texts]
        score, evidence = once[places], [found[i] for i in places]
        named = [[{"doc_id": i, "cosine": c} for i, c in e] for e in evidence]
        columns = [*(batch.column(c) for c in (0, 2, 3)), pa.array(score), pa.array((score >= DECISION).astype(np.int32)), pa.array(named, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "held_out", "score", "predicted", "evidence"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, tie (a hash of the text), held_out, score, predicted and the neighbours as evidence, for every row of ``docs``.

    Only doc_id and text are read. A text without a term of the examples, NULL and empty ones among them, has no neighbour and
    scores what such examples do. Repeated rows each come back. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("tie"), _is_held_out().alias("held_out"))
    return mapped(rows, lambda b: _scored(b, model), SCORED)
