"""Helpers shared by the operators: stored intermediate tables, row keys, and words of a batch as numpy arrays."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplake.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Later jobs start from the stored rows, so a lost executor costs the tasks it was running and nothing else, and a
    costly plan that is read twice is computed once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers once per application, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='code-')}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(made)
        _shipped.add(context.applicationId)


def mapped(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def text_key(text: str | Column = "text") -> Column:
    """Tells rows with one doc_id and several texts apart. NULL and empty texts share a key."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def packed_rows(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``doc`` (its doc_id) and ``tie`` beside it, so that names of other columns can't clash."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc"), text_key().alias("tie"))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A batch's texts as strings, NULL as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of at most ``rows`` rows and, single rows apart, about ``size`` bytes, to bound memory."""
    for batch in batches:
        step = rows
        if batch.num_rows:
            step = max(1, min(rows, int(size / max(1.0, batch.nbytes / batch.num_rows))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


# --- words of many texts at once ---------------------------------------------------------------------------------------
#: The white space that separates words.
SPACES = b"\t\n\x0b\x0c\r "
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True

_rng = np.random.default_rng(20240229)
#: A random odd-looking 64-bit number for each byte value, so that a word's hash is a keyed polynomial.
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the hash base, or of its inverse, modulo 2**64."""
    name = "inverse" if inverse else "base"
    if name not in _powers or len(_powers[name]) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, _BASE_INVERSE if inverse else _BASE, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name][:n]


def spans_hash(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of every span [start, end) over a sequence of 64-bit codes; equal spans hash alike wherever they lie.

    Prefix sums of code * base**i, taken modulo 2**64, minus those at the start, times base**-start.
    """
    if not len(codes):
        return np.zeros(len(starts), np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers(len(codes)), dtype=np.uint64)])
    raw = (sums[ends] - sums[starts]) * powers(len(codes), inverse=True)[np.minimum(starts, len(codes) - 1)]
    raw ^= raw >> np.uint64(29)
    raw *= np.uint64(0xBF58476D1CE4E5B9)
    return raw ^ (raw >> np.uint64(32))


def joined(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """Texts in one byte array, each followed by ``gap``, and where each begins (one entry more than texts)."""
    data = np.frombuffer(gap.join(texts) + gap if texts else b"", np.uint8)
    sizes = np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts))
    return data, np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([np.zeros(1, np.int8), mask.astype(np.int8), np.zeros(1, np.int8)]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    return runs(~_IS_SPACE[data])


def array(values: np.ndarray | list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)


def from_counts(counts: np.ndarray) -> np.ndarray:
    """0 .. count-1 for every count, one after the other."""
    total = int(counts.sum())
    starts = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(starts, counts)
