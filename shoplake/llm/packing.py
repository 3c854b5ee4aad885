"""Packing documents into training sequences along a Hilbert curve.

Every document becomes a hashed vector of its token counts, projected to a few dimensions by fixed random directions. Its
place on a Hilbert curve through that space orders the documents (a range sort), so documents with like words
follow each other. The ids are then laid end to end along the curve and cut every ``length`` ids, so only the last
sequence can have padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import cut, from_counts, mapped, slices, text_key, texts_of
from shoplake.llm.tokens import encoder

LENGTH = 2048
BUCKETS = 4096
DIMENSIONS = 4
LEVELS = 15  # bits for each dimension: 60 in all


def directions(buckets: int = BUCKETS, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The fixed random directions that hashed vectors are projected on."""
    return np.random.default_rng(7).standard_normal((buckets, dimensions))


def project(ids: list[np.ndarray], along: np.ndarray) -> np.ndarray:
    """Coordinates in (0, 1) of each document's hashed, damped and normalised token counts; an empty one is in the middle."""
    out = np.zeros((len(ids), along.shape[1]))
    for row, tokens in enumerate(ids):
        if len(tokens):
            hashed = (tokens.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(len(along))
            counts = np.bincount(hashed.astype(np.int64), minlength=len(along))
            present = np.flatnonzero(counts)
            weights = 1.0 + np.log(counts[present])
            out[row] = weights @ along[present] / np.sqrt(weights @ weights)
    return 1.0 / (1.0 + np.exp(-1.7 * out))


def hilbert_key(points: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Place on the Hilbert curve of points in (0, 1), with ``levels`` bits for each dimension.

    The coordinates' bits are turned, level by level, into the transposed index: a set bit flips the lower bits of the
    first axis, an unset one swaps them with the axis's own; Gray coding and interleaving finish the key.
    """
    dims = points.shape[1]
    axes = [np.minimum((points[:, d] * (1 << levels)).astype(np.int64), (1 << levels) - 1) for d in range(dims)]
    for level in range(levels - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            on = (axes[d] >> level) & 1 == 1
            swap = np.where(on, 0, (axes[0] ^ axes[d]) & low)
            first = np.where(on, axes[0] ^ low, axes[0] ^ swap)
            if d:
                axes[d] = axes[d] ^ swap
            axes[0] = first
    for d in range(1, dims):
        axes[d] = axes[d] ^ axes[d - 1]
    turn = np.zeros(len(points), np.int64)
    for level in range(levels - 1, 0, -1):
        turn ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros(len(points), np.int64)
    for level in range(levels - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | (((axes[d] ^ turn) >> level) & 1)
    return key


ENCODED = "doc_id long, tie long, curve_key long, n_ids long, ids binary"


def _encoded(batches: Iterator[pa.RecordBatch], path: str, style: str, end_id: int) -> Iterator[pa.RecordBatch]:
    tool, end, along = encoder(path, style), np.array([end_id], "<u4").tobytes(), directions()
    for batch in slices(batches):
        ids = [x + end for x in tool.encode(texts_of(batch))]
        key = hilbert_key(project([np.frombuffer(x, "<u4")[:-1] for x in ids], along))
        # 16 bits hold the ids of small vocabularies and halve what is stored and shuffled.
        small = [np.frombuffer(x, "<u4") for x in ids]
        stored = [b"\x02" + x.astype("<u2").tobytes() if x.max() < 65536 else b"\x04" + x.tobytes() for x in small]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(key), pa.array([len(x) for x in small], pa.int64()), pa.array(stored, pa.binary())],
            ["doc_id", "tie", "curve_key", "n_ids", "ids"],
        )


def unstored(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<u4")


PLACED = f"shard int, shard_start long, {ENCODED}"


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, start = TaskContext.get().partitionId(), 0
    for batch in batches:
        sizes = batch.column(3).to_numpy()
        ends = start + np.cumsum(sizes)
        first = [pa.array(np.full(len(sizes), shard), pa.int32()), pa.array(ends - sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(first + list(batch.columns), ["shard", "shard_start", *batch.schema.names])
        start = int(ends[-1]) if len(ends) else start


def pack(docs: DataFrame, tokenizer: str, style: str, end_id: int) -> DataFrame:
    """Every document's ids with their place on the packed line: doc_id, n_ids, ids (see ``unstored``), line_start.

    The line is cut into sequences every ``LENGTH`` ids; see ``pieces``. ``docs`` needs doc_id and text; other columns are not
    read. A NULL text is empty: its document is the end id alone. Equal documents share a curve key and are spread by doc_id
    and text, so a group of copies of any size is split over tasks. Rows that agree in both are placed one after the other. An
    empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("tie"))
    encoded = cut(mapped(rows, lambda b: _encoded(b, tokenizer, style, end_id), ENCODED), "packing-ids")
    keys = ["curve_key", "doc_id", "tie"]
    ordered = encoded.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut(mapped(ordered, _placed, PLACED), "packing-order")
    # A row per writing task, whatever the documents: what lies before each is the only thing that crosses tasks.
    sizes = placed.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    before = F.expr("sum(size) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    bases = sizes.select("shard", F.coalesce(before, F.lit(0)).cast("long").alias("base"))
    line = placed.join(F.broadcast(bases), "shard").withColumn("line_start", F.col("base") + F.col("shard_start"))
    return line.select("doc_id", "n_ids", "ids", "line_start", "curve_key")


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_id, sizes, stored, begins = batch.column(0), batch.column(1).to_numpy(), batch.column(2), batch.column(3).to_numpy()
        n = (begins + sizes - 1) // length - begins // length + 1
        of, sequence = np.repeat(np.arange(len(n)), n), np.repeat(begins // length, n) + from_counts(n)
        start = np.maximum(sequence * length, begins[of]) - begins[of]
        end = np.minimum((sequence + 1) * length, begins[of] + sizes[of]) - begins[of]
        sums, held, at = np.zeros(len(of), np.int64), b"", -1
        for k, (row, a, b) in enumerate(zip(of.tolist(), start.tolist(), end.tolist(), strict=True)):
            if row != at:
                held, at = unstored(stored[row].as_py()).tobytes(), row
            sums[k] = zlib.crc32(held[4 * a : 4 * b])
        columns = [start, end - start, sums, sizes[of], sequence, begins[of] + start - sequence * length]
        yield pa.RecordBatch.from_arrays([doc_id.take(pa.array(of)), *(pa.array(c, pa.int64()) for c in columns)], PIECES.replace(" long", "").split(", "))


def pieces(packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """The pieces the packed line is cut into: a row per document and sequence it lies in."""
    return mapped(packed.select("doc_id", "n_ids", "ids", "line_start"), lambda b: _pieces(b, length), PIECES)


SEQUENCES = "sequence_id long, offset long, ids binary"


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, bytes]] = []
        for data, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids, at = unstored(data), 0
            while at < len(ids):
                sequence, offset = divmod(begin + at, length)
                out.append((sequence, offset, ids[at : at + length - offset].tobytes()))
                at += length - offset
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["sequence_id", "offset", "ids"])


def sequences(packed: DataFrame, pad_id: int, length: int = LENGTH) -> DataFrame:
    """The training sequences: sequence_id, n_ids, and ids (little-endian unsigned 32-bit, padded to ``length``).

    A sequence that is shorter is padded, except at a power of two. At most ``length`` pieces meet in a group.
    """
    cut_up = mapped(packed.select("ids", "line_start"), lambda b: _cut(b, length), SEQUENCES)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = cut_up.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    n = (F.octet_length("joined") / 4).cast("long")
    padding = F.when(F.bit_count(n) == 1, F.lit(0)).otherwise(F.lit(length) - n)
    one = F.lit(int(pad_id).to_bytes(4, "little"))
    pad = F.aggregate(F.array_repeat(one, padding.cast("int")), F.lit(b""), lambda done, x: F.concat(done, x))
    return whole.select("sequence_id", ids.alias("joined")).select("sequence_id", n.alias("n_ids"), F.concat("joined", pad).alias("ids"))
