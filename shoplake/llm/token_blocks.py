"""Token ids stored in patched frame-of-reference blocks.

Documents are laid out in ascending doc_id order. Each task of the range-sorted stream writes segments: a run of whole
documents, with their ids in blocks of ``BLOCK`` values. A block keeps its minimum, the width that holds a
percentile of its values after subtracting the minimum, those values' low bits packed back to back, and a list of
exceptions (position and high bits) for the values that need more. A segment's index has the place of every block and every
document's first id, so any document is decoded from its own blocks alone.

Segments are rows of a Parquet table, written by Spark's committer: a task that is lost leaves nothing behind.

Segment bytes, little-endian: magic ``PFR1``; counts of documents, ids and blocks (u8 each); token counts (u8 per document);
block starts in the payload (u8, one more than blocks); minimum (u4), width (u1) and exception count (u2) per block; payload.
A block's payload: packed values (64 values per ``width`` words of 64 bits), exception positions (u2), high bits (u4).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import cut, mapped, slices, text_key, texts_of
from shoplake.llm.tokens import encoder

BLOCK = 1024
PERCENTILE = 99.0
SEGMENT_IDS = 1 << 18
_MAGIC = b"PFR1"


# --- one block column at a time, all blocks of one width together -----------------------------------------------------------
def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of 64-bit words."""
    lanes = values.reshape(-1, 64).astype("<u8")
    words = np.zeros((len(lanes), width), "<u8")
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = words.reshape(-1, width).astype("<u8")
    values = np.empty((len(rows), 64), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        values[:, lane] = rows[:, word] >> np.uint64(shift)
        if shift + width > 64:
            values[:, lane] |= rows[:, word + 1] << np.uint64(64 - shift)
    values &= np.uint64((1 << width) - 1)
    return values.astype("<u4").reshape(len(words), -1)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits needed for each value below 2**32."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def write_segment(ids: np.ndarray, counts: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """A segment of the documents whose ids lie one after the other in ``ids``."""
    n_blocks = -(-len(ids) // BLOCK)
    pad = n_blocks * BLOCK - len(ids)
    # What fills up the last block is its own minimum, which takes no bits.
    filler = ids[len(ids) - len(ids) % BLOCK :].min(initial=2**32 - 1) if pad else 0
    table = np.append(ids, np.full(pad, filler, "<u4")).astype("<u4").reshape(n_blocks, BLOCK)
    lows = table.min(axis=1, initial=2**32 - 1) if n_blocks else np.zeros(0, "<u4")
    table = table - lows[:, None].astype("<u4")
    kth = min(BLOCK - 1, int(BLOCK * percentile / 100))
    widths = np.maximum(1, _bits(np.partition(table, kth, axis=1)[:, kth])) if n_blocks else np.zeros(0, np.int64)
    patched = _bits(table) > widths[:, None]
    exceptions = patched.sum(axis=1)
    payload: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        packed = _pack(table[rows] & np.uint32((1 << int(width)) - 1), int(width))
        for row, words in zip(rows, packed, strict=True):
            where = np.flatnonzero(patched[row])
            high = table[row, where] >> np.uint32(width)
            payload[row] = words.tobytes() + where.astype("<u2").tobytes() + high.astype("<u4").tobytes()
    starts = np.concatenate([[0], np.cumsum([len(p) for p in payload])]).astype("<u8")
    head = [np.array([len(counts), len(ids), n_blocks], "<u8"), counts.astype("<u8"), starts, lows.astype("<u4")]
    head += [widths.astype("<u1"), exceptions.astype("<u2")]
    return _MAGIC + b"".join(h.tobytes() for h in head) + b"".join(payload)


class Segment:
    """A stored segment; decodes the blocks that are asked for."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a token segment")
        self.data, self.at = data, 4
        n_docs, self.n_ids, n_blocks = (int(x) for x in self._take("<u8", 3))
        self.counts = self._take("<u8", n_docs).astype(np.int64)
        self.block_starts = self._take("<u8", n_blocks + 1).astype(np.int64)
        self.lows, self.widths, self.exceptions = self._take("<u4", n_blocks), self._take("<u1", n_blocks), self._take("<u2", n_blocks)

    def _take(self, kind: str, n: int) -> np.ndarray:
        found = np.frombuffer(self.data, kind, n, self.at)
        self.at += found.nbytes
        return found

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first .. last-1."""
        out = np.empty((last - first, BLOCK), "<u4")
        widths = self.widths[first:last]
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            words = BLOCK // 64 * int(width)
            raw = np.stack([np.frombuffer(self.data, "<u8", words, self.at + self.block_starts[first + r]) for r in rows])
            out[rows] = _unpack(raw, int(width))
        for row in np.flatnonzero(self.exceptions[first:last]):
            block, n = first + row, int(self.exceptions[first + row])
            at = self.at + self.block_starts[block] + BLOCK // 8 * int(self.widths[block])
            where = np.frombuffer(self.data, "<u2", n, at)
            out[row, where] |= np.frombuffer(self.data, "<u4", n, at + 2 * n) << np.uint32(self.widths[block])
        return (out + self.lows[first:last, None]).reshape(-1)

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """The segment's ids start .. end-1."""
        end = self.n_ids if end is None else end
        first, last = start // BLOCK, -(-end // BLOCK)
        if end <= start:
            return np.zeros(0, "<u4")
        return self.blocks(first, last)[start - first * BLOCK : end - first * BLOCK]

    def document(self, n: int) -> np.ndarray:
        start = int(self.counts[:n].sum())
        return self.ids(start, start + int(self.counts[n]))


# --- the stored table ---------------------------------------------------------------------------------------------------
SEGMENTS = "shard int, segment int, shard_start long, n_ids long, doc_ids array<long>, data binary"


def _segments(batches: Iterable[pa.RecordBatch], path: str, style: str, end_id: int) -> Iterator[pa.RecordBatch]:
    tool, end = encoder(path, style), np.array([end_id], "<u4").tobytes()
    shard = TaskContext.get().partitionId()
    names: list[int | None] = []
    parts: list[bytes] = []
    held = number = start = 0

    def segment() -> pa.RecordBatch:
        data = write_segment(np.frombuffer(b"".join(parts), "<u4"), np.array([len(p) // 4 for p in parts], np.int64))
        row = [[shard], [number], [start], [held], [names], [data]]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True)],
            ["shard", "segment", "shard_start", "n_ids", "doc_ids", "data"],
        )

    for batch in slices(batches):
        doc_ids = batch.column(0).to_pylist()
        for doc_id, ids in zip(doc_ids, tool.encode(texts_of(batch)), strict=True):
            names.append(doc_id)
            parts.append(ids + end)
            held += len(ids) // 4 + 1
            if held >= SEGMENT_IDS:
                yield segment()
                number, start, held, names, parts = number + 1, start + held, 0, [], []
    if names:
        yield segment()


def write_tokens(docs: DataFrame, tokenizer: str, style: str, end_id: int, label: str = "tokens") -> DataFrame:
    """Encode every document, append ``end_id``, and store the ids in ascending doc_id order.

    ``docs`` needs doc_id and text; other columns are not read. A NULL text is empty and stored as the end id alone. Rows
    with one doc_id are kept apart, in the order of a hash of their texts; NULL doc_ids come first. An empty table gives an
    empty store. Returns the stored table of segments (``SEGMENTS``).
    """
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keys = ["doc_id", text_key()]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    made = mapped(ordered, lambda batches: _segments(batches, tokenizer, style, end_id), SEGMENTS)
    return cut(made, label)


def shard_starts(stored: DataFrame) -> DataFrame:
    """For each shard, the number of ids in all shards before it; a row per writing task."""
    sizes = stored.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = F.expr("sum(ids) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    return sizes.select("shard", F.coalesce(before, F.lit(0)).cast("long").alias("base"))


DIGESTS = "shard int, doc_id long, shard_start long, n_tokens long, ids_crc32 long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard, start, doc_ids, data = (batch.column(c)[row].as_py() for c in range(4))
            stored = Segment(data)
            ids, ends = stored.ids().astype("<u4"), np.cumsum(stored.counts)
            begins = ends - stored.counts
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ends), shard), pa.int32()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(begins + start, pa.int64()),
                    pa.array(stored.counts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["shard", "doc_id", "shard_start", "n_tokens", "ids_crc32"],
            )


def token_digests(stored: DataFrame) -> DataFrame:
    """From the stored segments: doc_id, start (ids of all documents before it), n_tokens, crc32 of the document's ids."""
    read = mapped(stored.select("shard", "shard_start", "doc_ids", "data"), _digests, DIGESTS)
    placed = read.join(shard_starts(stored), "shard")
    return placed.select("doc_id", (F.col("shard_start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def _document(batches: Iterator[pa.RecordBatch], wanted: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            stored, names = Segment(batch.column(1)[row].as_py()), batch.column(0)[row].as_py()
            for n, name in enumerate(names):
                if name in wanted:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name], pa.int64()), pa.array([stored.document(n).tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"]
                    )


def read_documents(stored: DataFrame, doc_ids: list[int]) -> DataFrame:
    """The ids of some documents, decoding only the blocks they lie in. Rows: doc_id, ids (array of long)."""
    wanted = list(doc_ids)
    some = stored.filter(F.arrays_overlap("doc_ids", F.lit(wanted).cast("array<long>"))) if wanted else stored.limit(0)
    return mapped(some.select("doc_ids", "data"), lambda b: _document(b, wanted), "doc_id long, ids array<long>")
