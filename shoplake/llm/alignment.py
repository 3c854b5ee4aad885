"""Cross-tokenizer alignment by pointer jumping.

A text's tokens by two vocabularies cover the same bytes. Tokens that overlap, directly or through others, form a group: between
groups, and nowhere else, both vocabularies end a token. Every token points to its farthest-right overlapping token; successors
are doubled until nothing moves, and the terminal token that all of a group reach is its label.

Neither vocabulary joins a word with the white space behind it, some signs with a carriage return apart, so a text's tokens and groups
are those of its pieces (white space and the word that follows), one after the other. A worker aligns each distinct piece about
once.

How many documents hold a pair of ids linked is a count over the corpus. Documents are dealt into chunks of bounded size; a chunk
knows each of its distinct pairs once, with the number of its documents that hold it, so what is shuffled and joined is a
row for each chunk and pair, and not one for each document and pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import BYTE_CODES, cut, from_counts, joined, mapped, slices, spans_hash, texts_of
from shoplake.llm.tokens import Encoder, white_space

#: Bytes of text and rows that close a chunk (a single longer text is a chunk of its own): they bound a task's memory.
CHUNK_BYTES, CHUNK_ROWS = 12 << 20, 50_000
#: Pieces that are looked up at once.
PIECES_AT_ONCE = 200_000
#: A pair of ids is one number.
SHIFT = 16
#: A worker's remembered pieces and their links, at most; they bound memory.
MOST_KNOWN, MOST_LINKS = 600_000, 4_000_000
#: Links of documents that are told apart at once.
LINKS_AT_ONCE = 1_000_000

_BLANK = "▁"


# --- groups ------------------------------------------------------------------------------------------------------------
def jump(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Label of each token, A's first: the terminal token of its group. Both lists of byte offsets end at the same byte.

    Tokens are numbered by where they end, A's before B's at one place. A token's farthest-right overlapping token is the one of the
    other vocabulary that holds its last byte, if that ends further right or is B's at the same place; else the token itself.
    """
    n_a, n_b = len(a_ends), len(b_ends)
    # The token of the other side that holds this one's last byte.
    of_a = np.searchsorted(b_ends, a_ends)
    of_b = np.searchsorted(a_ends, b_ends)
    successor = np.arange(n_a + n_b)
    successor[:n_a] = n_a + of_a  # B's token ends there or further right
    further = a_ends[of_b] > b_ends
    successor[n_a:][further] = of_b[further]
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor
        successor = doubled


def group_numbers(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of each token's group, from 0 in byte order, for A's tokens and B's, and how many there are."""
    label = jump(a_ends, b_ends)
    # Labels are B's last tokens of the groups, which lie in byte order.
    terminal, number = np.unique(label, return_inverse=True)
    return number[: len(a_ends)], number[len(a_ends) :], len(terminal)


def group_links(a_ids: np.ndarray, b_ids: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair and number of linked occurrences for every pair of different ids that share a group.

    Ids that a group repeats are counted before they are paired.
    """

    def counted(of: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, times = np.unique((of.astype(np.int64) << SHIFT) | ids, return_counts=True)
        return keys >> SHIFT, keys & ((1 << SHIFT) - 1), times

    group_a, a, times_a = counted(of_a, a_ids)
    group_b, b, times_b = counted(of_b, b_ids)
    size_b = np.bincount(group_b, minlength=n)
    first_b = np.cumsum(size_b) - size_b
    each = size_b[group_a]
    left = np.repeat(np.arange(len(a)), each)
    right = first_b[group_a[left]] + from_counts(each)
    return group_a[left], (a[left] << SHIFT) | b[right], times_a[left] * times_b[right]


def written(a_ids: np.ndarray, b_ids: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, n: int) -> list[str]:
    """Each group as ``a1,a2|b1``."""
    a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
    a_at = np.searchsorted(of_a, np.arange(n + 1)).tolist()
    b_at = np.searchsorted(of_b, np.arange(n + 1)).tolist()
    return [f"{','.join(a_text[a_at[g] : a_at[g + 1]])}|{','.join(b_text[b_at[g] : b_at[g + 1]])}" for g in range(n)]


# --- a worker's two vocabularies -----------------------------------------------------------------------------------------
class Aligner(Encoder):
    """Both encoders and a memory of pieces; a piece's entry has its A ids (in the parent), counts, links and written groups."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.pieces_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n = self.pieces_b.get_piece_size()
        self.bytes_b = [bytes([int(self.pieces_b.id_to_piece(i)[3:5], 16)]) if self.pieces_b.is_byte(i) else self.pieces_b.id_to_piece(i).replace(_BLANK, " ").encode() for i in range(n)]
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        all_b = [self.pieces_b.id_to_piece(i) for i in range(n) if not self.pieces_b.is_byte(i)]
        if any(_BLANK in p.lstrip(_BLANK) or "\n" in p for p in all_b):
            raise ValueError("the second vocabulary joins words, so its texts cannot be aligned piece by piece")
        # First bytes of the white space that B joins with what stands before it.
        self.joining = np.zeros(256, bool)
        for p in all_b:
            for before, c in zip(p, p[1:], strict=False):
                if c.isspace() and not before.isspace() and before != _BLANK:
                    self.joining[c.encode()[0]] = True
        super().__init__(path_a, "bytes")

    def _forget(self) -> None:
        super()._forget()
        self.counts = np.zeros((MOST_KNOWN, 4), np.int32)  # A's tokens, B's, groups, links; -1 where B's bytes differ
        self.text: list[str] = []
        self.link_at, self.link_n = np.zeros(MOST_KNOWN, np.int32), np.zeros(MOST_KNOWN, np.int32)
        self.pairs, self.times = np.zeros(1 << 20, np.uint32), np.zeros(1 << 20, np.int32)
        self.n_links = 0

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, first byte and end of every piece that neither vocabulary joins with its neighbours."""
        of, begin, end = super().pieces(data, offsets)
        on = np.zeros(len(of), bool)
        on[1:] = self.joining[data[begin[1:]]] & (of[1:] == of[:-1])
        if not on.any():
            return of, begin, end
        first = np.flatnonzero(~on)
        return of[first], begin[first], end[np.append(first[1:], len(of)) - 1]

    def _separable(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return super()._separable(data, begin, end) & ~white_space(data)[end - 1]

    def _encode_b(self, pieces: list[str]) -> list[np.ndarray]:
        """B's ids of pieces as they are inside a text: a line end, which is never joined with anything, stands before each."""
        found = []
        for ids in self.pieces_b.encode(["\n" + p for p in pieces], num_threads=1):
            found.append(np.array(ids[2:], np.int64))  # the blank that B adds, and the line end
        return found

    def _align(self, pieces: list[str], all_a: list[np.ndarray]) -> None:
        """Fill in the newest entries."""
        all_b = self._encode_b(pieces)
        first = self.n_pieces - len(pieces)
        raw = [p.encode() for p in pieces]
        whole = np.array([b"".join([self.bytes_b[i] for i in b.tolist()]) == r for b, r in zip(all_b, raw, strict=True)])
        self.text.extend([""] * len(pieces))
        self.counts[first : self.n_pieces] = -1
        good = np.flatnonzero(whole)
        if not len(good):
            return
        a_n = np.array([len(all_a[k]) for k in good])
        b_n = np.array([len(all_b[k]) for k in good])
        a_ids = np.concatenate([all_a[k] for k in good]).astype(np.int64)
        b_ids = np.concatenate([all_b[k] for k in good]).astype(np.int64)
        # The pieces stand side by side; both vocabularies end a token where one ends, so no group crosses over.
        of_a, of_b, n = group_numbers(np.cumsum(self.sizes[a_ids]), np.cumsum(self.size_b[b_ids]))
        groups = written(a_ids, b_ids, of_a, of_b, n)
        group, pair, times = group_links(a_ids, b_ids, of_a, of_b, n)
        ends = np.concatenate([[0], of_a[np.cumsum(a_n) - 1] + 1])  # the groups of a piece
        piece = np.searchsorted(ends, group, side="right") - 1
        order = np.lexsort((pair, piece))
        piece, pair, times = piece[order], pair[order], times[order]
        new = np.concatenate([[True], (piece[1:] != piece[:-1]) | (pair[1:] != pair[:-1])])
        at = np.flatnonzero(new)
        piece, pair, times = piece[at], pair[at], np.add.reduceat(times, at)
        links = np.bincount(piece, minlength=len(good))
        total = np.bincount(piece, weights=times, minlength=len(good)).astype(np.int64)
        while self.n_links + len(pair) > len(self.pairs):
            self.pairs, self.times = np.append(self.pairs, np.zeros_like(self.pairs)), np.append(self.times, np.zeros_like(self.times))
        self.pairs[self.n_links : self.n_links + len(pair)], self.times[self.n_links : self.n_links + len(pair)] = pair, times
        entry = first + good
        self.link_at[entry], self.link_n[entry] = self.n_links + np.cumsum(links) - links, links
        self.n_links += len(pair)
        self.counts[entry] = np.stack([a_n, b_n, np.diff(ends), total], 1)
        for k, a, b in zip(good.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            self.text[first + k] = ";".join(groups[a:b])

    def keys_of(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return np.maximum(spans_hash(BYTE_CODES[data], begin, end), np.uint64(1))

    def full(self, keys: np.ndarray) -> bool:
        """Whether those of some pieces that are new may not fit what is remembered."""
        if self.n_links > MOST_LINKS:
            return True
        return self.n_pieces + len(keys) > MOST_KNOWN and self.n_pieces + len(np.unique(keys[self._look_up(keys) < 0])) > MOST_KNOWN

    def entries(self, keys: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Entry of each piece; pieces not met before are encoded and aligned. ``full`` must have been asked before."""
        entry = self._look_up(keys)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            unknown, first = np.unique(keys[missing], return_index=True)
            at, raw = missing[first], data.tobytes()
            new = [raw[x:y].decode() for x, y in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            ids = self.learn(new, self._separable(data, begin[at], end[at]).tolist())
            self._add(unknown, ids)
            self._align(new, ids)
            entry[missing] = self._look_up(keys[missing])
        return entry

    def links(self, entry: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of ``entry``, pair and occurrences of all links of the entries, each of which occurs ``times`` times."""
        n = self.link_n[entry]
        row = np.repeat(np.arange(len(entry)), n)
        at = self.link_at[entry][row] + from_counts(n)
        return row, self.pairs[at].astype(np.int64), self.times[at].astype(np.int64) * times[row]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner for two vocabulary files, a byte-level one and a sentence-piece one."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


# --- chunks of documents ---------------------------------------------------------------------------------------------------
#: Rows of documents, and for each chunk one row with its pairs: how many of its documents hold each, and its units' pairs. A unit
#: is a piece, or a whole text that is too long to be kept as pieces. Documents name their units (``packed``).
CHUNKS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, units binary, "
    "pairs array<int>, docs array<int>, unit_ends array<int>, unit_pairs array<int>, unit_times array<long>"
)
_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]
_TYPES = [
    *[pa.int64()] * 6,
    pa.string(),
    pa.binary(),
    *[pa.list_(pa.int32())] * 4,
    pa.list_(pa.int64()),
]


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def packed(units: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each document's units, in ascending order and as often as they occur, as differences of three bytes.

    A document's low bytes come first, then its middle and its high ones, which are mostly zero and so cost little when compressed.
    """
    first = np.cumsum(counts) - counts
    differ = np.diff(units, prepend=0)
    begins = first[counts > 0]
    differ[begins] = units[begins]
    out = np.empty(3 * len(units), np.uint8)
    at, step = np.arange(len(units)) + np.repeat(2 * first, counts), np.repeat(counts, counts)
    for byte in range(3):
        out[at + byte * step] = (differ >> (8 * byte)) & 255
    ends = np.concatenate([[0], 3 * np.cumsum(counts)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and unit of every entry of ``packed`` documents."""
    sizes = pc.binary_length(column).to_numpy()
    counts = sizes // 3
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    first = np.cumsum(counts) - counts
    at, step = np.arange(int(counts.sum())) + np.repeat(2 * first, counts), np.repeat(counts, counts)
    differ = np.zeros(len(at), np.int64)
    for byte in range(3):
        differ |= data[at + byte * step].astype(np.int64) << (8 * byte)
    sums = np.concatenate([[0], np.cumsum(differ)])
    return np.repeat(np.arange(len(counts)), counts), sums[1:] - np.repeat(sums[first], counts)


def _row_sums(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers by row."""
    out = np.zeros(n, np.int64)
    np.add.at(out, row, values)
    return out


class _Chunk:
    """Documents of a chunk in the making."""

    def __init__(self, number: int):
        self.number, self.size, self.rows = number, 0, 0
        self.doc_ids: list[int | None] = []
        self.numbers: list[np.ndarray] = []  # of some documents: n_a, n_b, n_groups, n_links
        self.shas: list[str] = []
        self.used: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # document, entry, times
        self.long: list[tuple[int, np.ndarray, np.ndarray]] = []  # document, its pairs and their occurrences

    def add(self, doc_ids: list[int | None], numbers: np.ndarray, shas: list[str], size: int) -> None:
        self.doc_ids.extend(doc_ids)
        self.numbers.append(numbers)
        self.shas.extend(shas)
        self.rows, self.size = self.rows + len(doc_ids), self.size + size

    def _units(self, tool: Aligner) -> tuple[np.ndarray, ...]:
        """Document, unit and times of what documents use, and unit, pair and occurrences of the units' links."""
        none = np.zeros(0, np.int64)
        doc, entry, times = (np.concatenate(x) for x in zip(*self.used, strict=True)) if self.used else (none, none, none)
        self.used = []
        known, unit = np.unique(entry, return_inverse=True)
        row, pair, each = tool.links(known, np.ones(len(known), np.int64))
        if self.long:
            # A long text is a unit of its own, after the pieces.
            numbers = len(known) + np.arange(len(self.long))
            row = np.concatenate([row, *(np.full(len(p), k) for k, (_, p, _) in zip(numbers, self.long, strict=True))])
            pair = np.concatenate([pair, *(p for _, p, _ in self.long)])
            each = np.concatenate([each, *(t for _, _, t in self.long)])
            doc = np.concatenate([doc, np.array([d for d, _, _ in self.long])])
            unit, times = np.concatenate([unit, numbers]), np.concatenate([times, np.ones(len(numbers), np.int64)])
        order = np.argsort(doc * np.int64(max(1, unit.max(initial=0) + 1)) + unit, kind="stable")
        doc, unit, times = doc[order], unit[order], times[order]
        return doc, unit, times, row, pair, each

    def _holding(self, ends: np.ndarray, doc: np.ndarray, unit: np.ndarray, first: np.ndarray, n_pairs: np.ndarray, at: np.ndarray, total: int) -> np.ndarray:
        """How many documents hold each pair; a document counts once however many of its units hold it."""
        docs, start = np.zeros(total, np.int64), 0
        work = np.concatenate([[0], np.cumsum(n_pairs[unit])])[ends]
        while start < self.rows:
            # Some documents at a time, to bound memory.
            stop = max(start + 1, int(np.searchsorted(work, work[start] + LINKS_AT_ONCE, side="right")) - 1)
            some = slice(ends[start], ends[stop])
            n = n_pairs[unit[some]]
            where = np.repeat(first[unit[some]], n) + from_counts(n)
            held = np.sort(np.repeat(doc[some] - start, n) * np.int64(max(1, total)) + at[where])
            held = held[np.concatenate([[True], held[1:] != held[:-1]])[: len(held)]]
            docs += np.bincount(held % max(1, total), minlength=total)
            start = stop
        return docs

    def batches(self, tool: Aligner) -> Iterator[pa.RecordBatch]:
        doc, unit, times, row, pair, each = self._units(tool)
        n_units = int(max(row.max(initial=-1), unit.max(initial=-1))) + 1
        pairs, at = np.unique(pair, return_inverse=True)
        n_pairs = np.bincount(row, minlength=n_units)
        first = np.cumsum(n_pairs) - n_pairs
        units_of = np.bincount(doc, minlength=self.rows)
        ends = np.concatenate([[0], np.cumsum(units_of)])
        docs = self._holding(ends, doc, unit, first, n_pairs, at, len(pairs))
        numbers = np.concatenate(self.numbers)
        for a in range(0, self.rows, 4096):
            b = min(self.rows, a + 4096)
            some = slice(ends[a], ends[b])
            of_row = _row_sums(doc[some] - a, times[some], b - a)
            counts = [pa.array(numbers[a:b, k], pa.int64()) for k in range(4)]
            made = [pa.array(self.doc_ids[a:b], pa.int64()), *counts, pa.array(self.shas[a:b], pa.string())]
            yield self._batch(b - a, [*made, packed(np.repeat(unit[some], times[some]).astype(np.int64), of_row)], 1)
        lists = [pairs.astype(np.uint32).view(np.int32), docs.astype(np.int32), (first + n_pairs).astype(np.int32), at.astype(np.int32)]
        made = [_lists(x, np.array([len(x)]), pa.int32()) for x in lists] + [_lists(each, np.array([len(each)]), pa.int64())]
        yield self._batch(1, made, 8)

    def _batch(self, n: int, made: list[pa.Array], first: int) -> pa.RecordBatch:
        columns = [pa.nulls(n, t) for t in _TYPES]
        columns[0] = pa.array(np.full(n, self.number), pa.int64())
        columns[first : first + len(made)] = made
        return pa.RecordBatch.from_arrays(columns, _NAMES)


class _Writer:
    """Deals a task's documents into chunks."""

    def __init__(self, tool: Aligner, number: int):
        self.tool, self.chunk = tool, _Chunk(number)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.chunk.rows:
            yield from self.chunk.batches(self.tool)
            self.chunk = _Chunk(self.chunk.number + 1)

    def add(self, doc_ids: list[int | None], texts: list[str]) -> Iterator[pa.RecordBatch]:
        """Align some texts. Before the memory that an open chunk refers to is emptied, the chunk is closed."""
        data, offsets = joined([(" " + t if t else "").encode() for t in texts])
        of, begin, end = self.tool.pieces(data, offsets)
        if len(begin) > PIECES_AT_ONCE and len(texts) > 1:
            half = len(texts) // 2
            yield from self.add(doc_ids[:half], texts[:half])
            yield from self.add(doc_ids[half:], texts[half:])
            return
        if len(begin) > PIECES_AT_ONCE:
            yield from self.close()
            self._long(doc_ids, data, begin, end)
            yield from self.close()
            return
        keys = self.tool.keys_of(data, begin, end)
        if self.tool.full(keys):
            yield from self.close()
            self.tool._forget()
        self._usual(doc_ids, of, self.tool.entries(keys, data, begin, end), len(data))
        if self.chunk.size >= CHUNK_BYTES or self.chunk.rows >= CHUNK_ROWS:
            yield from self.close()

    def _usual(self, doc_ids: list[int | None], of: np.ndarray, entry: np.ndarray, size: int) -> None:
        rows, tool = len(doc_ids), self.tool
        counts = tool.counts[entry]
        bad = np.zeros(rows, bool)
        bad[of[counts[:, 0] < 0]] = True
        good = ~bad[of]
        n_pieces = np.bincount(of, minlength=rows)
        numbers = np.stack([np.bincount(of[good], weights=counts[good, k], minlength=rows) for k in range(4)], 1).astype(np.int64)
        places, at, text, shas = entry.tolist(), np.concatenate([[0], np.cumsum(n_pieces)]).tolist(), tool.text, [""] * rows
        for k in np.flatnonzero(~bad & (n_pieces > 0)).tolist():
            shas[k] = hashlib.sha256(";".join([text[e] for e in places[at[k] : at[k + 1]]]).encode()).hexdigest()
        held, times = np.unique(of[good].astype(np.int64) * MOST_KNOWN + entry[good], return_counts=True)
        used = held // MOST_KNOWN + self.chunk.rows, held % MOST_KNOWN, times
        self.chunk.used.append(tuple(x.astype(np.int32) for x in used))
        self.chunk.add(doc_ids, numbers, shas, size)

    def _long(self, doc_ids: list[int | None], data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """One text with very many pieces, which are looked up some at a time."""
        tool, digest = self.tool, hashlib.sha256()
        total, pairs, times, whole = np.zeros(4, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), True
        for at in range(0, len(begin), PIECES_AT_ONCE):
            some = slice(at, at + PIECES_AT_ONCE)
            keys = tool.keys_of(data, begin[some], end[some])
            if tool.full(keys):
                tool._forget()
            entry = tool.entries(keys, data, begin[some], end[some])
            counts = tool.counts[entry]
            whole &= bool(counts.min() >= 0)
            total += counts.sum(0, dtype=np.int64)
            digest.update(((";" if at else "") + ";".join([tool.text[e] for e in entry.tolist()])).encode())
            known, n = np.unique(entry, return_counts=True)
            _, pair, each = tool.links(known, n)
            pairs, where = np.unique(np.concatenate([pairs, pair]), return_inverse=True)
            times = _row_sums(where, np.concatenate([times, each]), len(pairs))
        if whole:
            self.chunk.long.append((0, pairs, times))
        self.chunk.add(doc_ids, total[None] if whole else np.zeros((1, 4), np.int64), [digest.hexdigest() if whole else ""], len(data))


def _chunks(batches: Iterable[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    writer = _Writer(aligner(path_a, path_b), TaskContext.get().partitionId() << 32)
    for batch in slices(batches, rows=512, size=1 << 20):
        yield from writer.add(batch.column(0).to_pylist(), texts_of(batch))
    yield from writer.close()


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents and chunks (``CHUNKS``), stored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut(mapped(rows, lambda batches: _chunks(batches, path_a, path_b), CHUNKS), "aligned")


# --- corpus-wide counts ------------------------------------------------------------------------------------------------------
def pair_counts(stored: DataFrame) -> DataFrame:
    """pair, a, b, how many documents hold it linked (``n_docs``), and whether no pair of its A id has more (``best``).

    Chunks' counts are added before they are shuffled. An A id has at most as many rows as the second vocabulary has ids.
    """
    each = stored.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    totals = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.docs").cast("long")).alias("n_docs"))
    # A pair is kept as a signed number of 32 bits.
    a = F.shiftrightunsigned("pair", SHIFT)
    totals = cut(totals.select("pair", a.alias("a"), F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)).alias("b"), "n_docs"), "pairs")
    most = totals.groupBy("a").agg(F.max("n_docs").alias("most"))
    return totals.join(most, "a").select("pair", "a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


SCORES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's documents, which follow its row of pairs with their corpus-wide counts."""
    _aligners.clear()  # this worker may have been one that encoded; what it remembers is no longer needed
    chunk, sums, best = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        numbers = batch.column(0).to_numpy()
        for a, b in zip(*_stretches(numbers), strict=True):
            part = batch.slice(a, b - a)
            if numbers[a] != chunk:
                # The first row has the chunk's pairs.
                chunk, head = numbers[a], part.slice(0, 1)
                at, n_docs, is_best, ends, of, each = (head.column(k).flatten().to_numpy(zero_copy_only=False) for k in range(8, 14))
                count, top = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                count[at], top[at] = n_docs, is_best
                unit = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                sums, best = _row_sums(unit, each * count[of], len(ends)), _row_sums(unit, each * top[of], len(ends))
                part = part.slice(1)
            if not part.num_rows:
                continue
            row, unit = unpacked(part.column(7))
            columns = [part.column(k) for k in (1, 2, 3, 4, 5)]
            columns += [pa.array(_row_sums(row, x[unit], part.num_rows), pa.int64()) for x in (best, sums)]
            yield pa.RecordBatch.from_arrays([*columns, part.column(6)], [c.split()[0] for c in SCORES.split(", ")])


def _stretches(numbers: np.ndarray) -> tuple[list[int], list[int]]:
    cuts = np.flatnonzero(np.diff(numbers)) + 1
    return [0, *cuts.tolist()] if len(numbers) else [], [*cuts.tolist(), len(numbers)] if len(numbers) else []


def scores(stored: DataFrame, counts: DataFrame) -> DataFrame:
    """The columns of ``SCORES`` for every document of ``aligned``.

    Each chunk's pairs are joined with their counts and go back to the chunk, which is bounded, and its documents are sorted after
    them; their sums are taken unit by unit.
    """
    mine = stored.filter("pairs IS NOT NULL").select("chunk", F.posexplode("pairs").alias("at", "pair"))
    found = mine.join(counts.select("pair", "n_docs", "best"), "pair").groupBy("chunk")
    heads = found.agg(F.collect_list(F.struct("at", "n_docs", F.col("best").cast("int").alias("best"))).alias("x"))
    units = stored.filter("pairs IS NOT NULL").select(F.col("chunk").alias("_chunk"), "unit_ends", "unit_pairs", "unit_times")
    heads = units.join(heads, F.col("_chunk") == F.col("chunk"), "left").drop("chunk")
    of_docs, of_units = _NAMES[1:8], ["unit_ends", "unit_pairs", "unit_times"]
    of_pairs = {"at": "array<int>", "n_docs": "array<bigint>", "best": "array<int>"}
    docs = stored.filter("pairs IS NULL").select(
        "chunk", *of_docs, *(F.lit(None).cast(t).alias(n) for n, t in of_pairs.items()), *of_units, F.lit(1).alias("kind")
    )
    first = heads.select(
        F.col("_chunk").alias("chunk"),
        *(F.lit(None).cast(stored.schema[n].dataType).alias(n) for n in of_docs),
        *(F.coalesce(f"x.{n}", F.array().cast(t)).alias(n) for n, t in of_pairs.items()),
        *of_units,
        F.lit(0).alias("kind"),
    )
    together = docs.unionByName(first).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return mapped(together, _score, SCORES)


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every document's tokens, groups, links and their corpus-wide counts.

    ``docs`` needs doc_id and text; other columns are not read. A NULL or empty text, and one that a vocabulary does not give back
    byte for byte, has no tokens: zeros and an empty digest. Every row is a document of its own, repeated rows and a NULL doc_id
    included. A text of any length is aligned whole, some pieces at a time. An empty table gives an empty result.
    """
    stored = aligned(docs, path_a, path_b)
    return scores(stored, pair_counts(stored))
