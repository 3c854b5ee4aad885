"""Encoding with public tokenizers, one piece of text at a time and each distinct piece about once per worker.

A vocabulary's rules part a text at white space before anything else, so a text's ids are those of its pieces, one after the other.
Pieces are found, hashed and looked up for many texts at once; only pieces that this worker has not met are given to the
tokenizers library. The look-up compares 64-bit hashes.
"""

from __future__ import annotations

import json
import os

import numpy as np

from shoplake.llm.common import BYTE_CODES, joined, runs, spans_hash

#: The characters that Unicode calls white space, as UTF-8.
_WHITE = [c.encode() for c in map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])]
_PLAIN_WHITE = np.zeros(256, bool)
_PLAIN_WHITE[[c[0] for c in _WHITE if len(c) == 1]] = True
_WIDE_WHITE = [c for c in _WHITE if len(c) > 1]
_WIDE_LEAD = np.zeros(256, bool)
_WIDE_LEAD[[c[0] for c in _WIDE_WHITE]] = True

#: Pieces and ids that a worker remembers at most. They bound memory: a piece has the same ids whether or not it was met before.
MOST_PIECES = 1_500_000
MOST_IDS = 16_000_000
_SLOTS = 1 << 22

#: Stops at the end of a word that are encoded apart from it.
_TAIL = ".,;:!?"
#: A word the word vocabulary encodes as one token, to tell pieces apart that are encoded together.
_MARK = "|"


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    white = _PLAIN_WHITE[data]
    lead = np.flatnonzero(_WIDE_LEAD[data])
    if len(lead):
        padded = np.append(data, np.zeros(2, np.uint8))
        for character in _WIDE_WHITE:
            at = lead[np.all([padded[lead + k] == byte for k, byte in enumerate(character)], axis=0)]
            for k in range(len(character)):
                white[at + k] = True
    return white


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    A byte-level vocabulary (style ``bytes``) keeps white space, which belongs to what follows it; the word vocabulary (``words``)
    drops it.
    """

    def __init__(self, path: str, style: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.style = style
        self.tails: dict[str, list[int]] = {}
        vocabulary = json.loads(self.tokenizer.to_str())["model"]["vocab"]
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            # A byte-level token is written with one character for each byte; a word's last token is marked.
            self.sizes[number] = len(token) if style == "bytes" else token.endswith("</w>")
        self.mark = self._ids(_MARK)[0] if style == "words" else -1
        self._forget()

    def _forget(self) -> None:
        self.keys, self.entry = np.zeros(_SLOTS, np.uint64), np.zeros(_SLOTS, np.int32)
        self.at, self.count = np.zeros(MOST_PIECES, np.int32), np.zeros(MOST_PIECES, np.int32)
        self.pool = np.zeros(1 << 20, np.uint32)
        self.n_pieces = self.n_ids = 0

    # --- pieces ---------------------------------------------------------------------------------------------------------
    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, first byte and end of every piece of texts that lie in ``data`` with one byte between them."""
        start, end = runs(~white_space(data))
        of = np.searchsorted(offsets, start, side="right") - 1
        if self.style == "words":
            return of, start, end
        first = np.concatenate([[True], of[1:] != of[:-1]])[: len(of)]
        begin = np.where(first, offsets[of], np.concatenate([[0], end[:-1]])[: len(of)])
        # White space at the end of a text is a piece of its own.
        last = offsets[:-1].copy()
        last[of] = end  # the last word's end counts, as later ones overwrite
        rest = np.flatnonzero(last < offsets[1:] - 1)
        if not len(rest):
            return of, begin, end
        of, begin, end = np.append(of, rest), np.append(begin, last[rest]), np.append(end, offsets[rest + 1] - 1)
        order = np.argsort(begin, kind="stable")
        return of[order], begin[order], end[order]

    # --- what the library is asked ----------------------------------------------------------------------------------------
    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _parted(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of each piece. They are encoded side by side, which is cheaper than one by one, and then parted."""
        skip = np.zeros(len(pieces), np.int64)
        if self.style == "bytes":
            # What stands at a text's beginning has nothing before it: a line end, one token, is put there and left out again.
            skip = np.array([p[0] not in " \n" for p in pieces], np.int64)
            written = [f"\n{p}" if k else p for p, k in zip(pieces, skip, strict=True)]
            ids = np.array(self._ids("".join(written)))
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(p.encode()) for p in written])) + 1
        elif all(p.lower().isalpha() for p in pieces):
            ids = np.array(self._ids(" ".join(pieces)))
            ends = np.flatnonzero(self.sizes[ids]) + 1
        else:
            ids = np.array(self._ids(f" {_MARK} ".join(pieces)))
            marks = np.append(np.flatnonzero(ids == self.mark), len(ids))
            ids, ends = np.delete(ids, marks[:-1]), marks - np.arange(len(marks))
        if len(ends) != len(pieces):
            return [np.array(self._ids(p)) for p in pieces]
        return [ids[a:b] for a, b in zip(np.append(0, ends[:-1]) + skip, ends, strict=True)]

    def _separable(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which pieces may be encoded beside others: in the byte vocabulary they need a word after at most one blank or line end."""
        if self.style == "words":
            return np.ones(len(begin), bool)
        first, second = data[begin], data[np.minimum(begin + 1, len(data) - 1)]
        lead = (first == 32) | (first == 10)
        inner = np.where(lead, second, first)
        return ~(_PLAIN_WHITE | _WIDE_LEAD)[inner] & ((end - begin > 1) | ~lead)

    def learn(self, pieces: list[str], separable: list[bool]) -> list[np.ndarray]:
        """The ids of distinct pieces."""
        found: list[np.ndarray] = [np.zeros(0)] * len(pieces)
        plain: list[tuple[int, str]] = []
        other: list[tuple[int, str]] = []
        for k, (piece, alone) in enumerate(zip(pieces, separable, strict=True)):
            if not alone or (self.style == "words" and _MARK in piece):
                found[k] = np.array(self._ids(piece))
            elif self.style == "bytes" or piece.isalpha():
                plain.append((k, piece))
            else:
                # Letters and the stops after them are encoded apart.
                core = piece.rstrip(_TAIL)
                (plain if core.isalpha() else other).append((k, core if core.isalpha() else piece))
        for some in (plain, other):
            for at in range(0, len(some), 512):
                part = some[at : at + 512]
                for (k, core), ids in zip(part, self._parted([c for _, c in part]), strict=True):
                    if len(core) < len(pieces[k]):
                        tail = pieces[k][len(core) :]
                        if tail not in self.tails:
                            self.tails[tail] = self._ids(tail)
                        ids = np.concatenate([ids, self.tails[tail]])
                    found[k] = ids
        return found

    # --- the worker's memory ----------------------------------------------------------------------------------------------
    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where there is none."""
        slot = (keys & np.uint64(_SLOTS - 1)).astype(np.int64)
        out = np.full(len(keys), -1)
        open_ = np.arange(len(keys))
        while len(open_):
            held = self.keys[slot]
            hit = held == keys[open_]
            out[open_[hit]] = self.entry[slot[hit]]
            on = ~hit & (held != 0)
            open_, slot = open_[on], (slot[on] + 1) & (_SLOTS - 1)
        return out

    def _add(self, keys: np.ndarray, ids: list[np.ndarray]) -> None:
        sizes = np.array([len(i) for i in ids], np.int64)
        total = int(sizes.sum())
        while self.n_ids + total > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        self.pool[self.n_ids : self.n_ids + total] = np.concatenate(ids) if total else 0
        new = slice(self.n_pieces, self.n_pieces + len(ids))
        self.at[new], self.count[new] = self.n_ids + np.cumsum(sizes) - sizes, sizes
        slots = (keys & np.uint64(_SLOTS - 1)).tolist()
        for number, (key, slot) in enumerate(zip(keys, slots, strict=True), self.n_pieces):
            while self.keys[slot]:
                slot = (slot + 1) & (_SLOTS - 1)
            self.keys[slot], self.entry[slot] = key, number
        self.n_pieces, self.n_ids = self.n_pieces + len(ids), self.n_ids + total

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(texts) > 1 and sum(map(len, texts)) > MOST_PIECES:  # so that a call's own pieces fit the memory
            half = len(texts) // 2
            return self.encode(texts[:half]) + self.encode(texts[half:])
        data, offsets = joined([t.encode() for t in texts])
        of, begin, end = self.pieces(data, offsets)
        keys = np.maximum(spans_hash(BYTE_CODES[data], begin, end), np.uint64(1))
        if self.n_pieces + len(keys) > MOST_PIECES or self.n_ids > MOST_IDS:
            fresh = np.unique(keys[self._look_up(keys) < 0])
            if self.n_pieces + len(fresh) > MOST_PIECES or self.n_ids > MOST_IDS:
                self._forget()
        entry = self._look_up(keys)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            unknown, first = np.unique(keys[missing], return_index=True)
            if len(unknown) > MOST_PIECES:  # one text with more distinct pieces than the memory holds
                return [np.array(self._ids(t), "<u4").tobytes() for t in texts]
            raw = data.tobytes()
            at = missing[first]
            new = [raw[a:b].decode() for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            self._add(unknown, self.learn(new, self._separable(data, begin[at], end[at]).tolist()))
            entry[missing] = self._look_up(keys[missing])
        sizes = self.count[entry]
        steps = np.cumsum(sizes)
        where = np.arange(int(sizes.sum())) + np.repeat(self.at[entry] - (steps - sizes), sizes)
        flat = self.pool[where].astype("<u4").tobytes()
        totals = np.concatenate([[0], steps])[np.searchsorted(of, np.arange(len(texts) + 1))] * 4
        return [flat[a:b] for a, b in zip(totals[:-1].tolist(), totals[1:].tolist(), strict=True)]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, style: str) -> Encoder:
    """This worker's encoder for a vocabulary file; ``style`` is ``bytes`` or ``words``, as its vocabulary is."""
    if (path, style) not in _encoders:
        _encoders[path, style] = Encoder(path, style)
    return _encoders[path, style]
