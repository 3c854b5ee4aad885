"""Substring deduplication by content-defined chunking.

A gear hash rolls over a text's bytes; at each word start it covers the 16 bytes before. A word start is cut where its hash is the
least among its neighbours', so the cuts depend on nearby bytes alone and an insertion moves only the chunks it touches.
Chunks are compared by 128-bit digest. A passage that repeats is a run of chunks that all occurred before; one of ``MIN_WORDS`` or
more is removed everywhere but at its first place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplake.llm.common import cut, joined, mapped, slices, text_key, texts_of, words_of

REACH = 3  # words on each side that a cut's hash is compared with: chunks of seven words on average
LONGEST = 64  # words; beyond it a chunk is cut anyway, as where one word repeats without end
#: A run of repeated chunks lies inside the repeated passage, short of it by a chunk at each end; 20 words of chunks are
#: found in any repeated passage of 50 words, and boilerplate lines stay.
MIN_WORDS = 20

GEAR = np.random.default_rng(16).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: byte codes shifted by their distance, over 16 bytes, by doubling."""
    rolled = GEAR[data]
    for step in (1, 2, 4, 8):
        older = np.zeros_like(rolled)
        older[step:] = rolled[:-step] << np.uint32(step)
        rolled = rolled + older
    return rolled


def cut_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of many texts: text number, first byte in it, last byte's end (without the space that follows), and words."""
    # An empty text in front and wide gaps: every text has 16 line ends before it, whatever it is cut with.
    data, offsets = joined([b"", *texts], b"\n" * 16)
    offsets = offsets[1:]
    starts, ends = words_of(data)
    of = np.searchsorted(offsets, starts, side="right") - 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    value = gear(data)[starts - 1]
    here = np.full(len(value), True)
    for step in range(1, REACH + 1):
        same = of[step:] == of[:-step]
        here[step:] &= ~same | (value[step:] < value[:-step])
        here[:-step] &= ~same | (value[:-step] <= value[step:])
    here |= np.concatenate([[True], of[1:] != of[:-1]])
    first = np.flatnonzero(here)
    sizes = np.diff(np.append(first, len(starts)))
    if (sizes > LONGEST).any():
        first = np.concatenate([np.arange(a, a + n, LONGEST) for a, n in zip(first, sizes, strict=True)])
        sizes = np.diff(np.append(first, len(starts)))
    of = of[first]
    return of, starts[first] - offsets[of], ends[first + sizes - 1] - offsets[of], sizes


CHUNKS = "rid long, place long, again boolean, h1 long, h2 long"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [t.encode() for t in texts_of(batch)]
        of, first, end, words = cut_words(texts)
        digest = xxhash.xxh3_128_digest
        found = [digest(texts[t][a:b]) for t, a, b in zip(of.tolist(), first.tolist(), end.tolist(), strict=True)]
        number = np.arange(len(of)) - np.searchsorted(of, of)
        again, seen, last = np.zeros(len(of), bool), set(), -1
        for k, (t, d) in enumerate(zip(of.tolist(), found, strict=True)):
            if t != last:
                seen, last = set(), t
            again[k] = d in seen
            seen.add(d)
        halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
        rid = batch.column(0).to_numpy()[of]
        columns = [pa.array(rid), pa.array(number << 8 | words), pa.array(again), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
        yield pa.RecordBatch.from_arrays(columns, ["rid", "place", "again", "h1", "h2"])


#: Row numbers from here on stand for rows whose doc_id is NULL or taken by another text.
_LATER = 1 << 62


def numbered(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``rid``: the doc_id, or a number beyond them where that is NULL or repeated, and ``many``: whether
    other rows may have the number too.

    Of several texts under one doc_id the one with the least hash has it. Rows that agree in doc_id and text share a number.
    """
    doc, tie = F.col("doc_id").cast("long"), text_key()
    rows = docs.select(F.struct("*").alias("row"), doc.alias("doc"), tie.alias("tie"))
    repeated = cut(docs.groupBy(doc.alias("r")).agg(F.count("*").alias("n"), F.min(tie).alias("lead")).filter("n > 1 OR r IS NULL"), "chunk-repeats")
    if repeated.isEmpty():
        return rows.select("row", F.col("doc").alias("rid"), F.lit(False).alias("many"))
    later = F.col("doc").isNull() | F.coalesce(F.col("tie") != F.col("lead"), F.lit(False))
    beyond = F.lit(_LATER) + F.xxhash64("doc", "tie").bitwiseAND(F.lit(_LATER // 2 - 1))
    rid = F.when(later, beyond).otherwise(F.col("doc")).alias("rid")
    return rows.join(repeated, F.col("doc") == F.col("r"), "left").select("row", rid, (F.col("r").isNotNull() | F.col("doc").isNull()).alias("many"))


def _spans(marks: list[dict], words_least: int) -> list[tuple[int, int, int, int]]:
    """Runs of repeated chunks: first and last chunk number, words, and the row that has the first chunk's first place."""
    out: list[tuple[int, int, int, int]] = []
    run: list[int] = []
    for place, first in sorted({(m["place"], m["first"]) for m in marks}):
        number, words = place >> 8, place & 255
        if run and number == run[1] + 1:
            run[1], run[2] = number, run[2] + words
        else:
            if run and run[2] >= words_least:
                out.append(tuple(run))
            run = [number, number, words, first]
    if run and run[2] >= words_least:
        out.append(tuple(run))
    return out


REMOVED = "text string, spans array<struct<start:long,end:long,n_words:long,first:long>>"


def _removed(batches: Iterator[pa.RecordBatch], words_least: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()), ("first", pa.int64())]))
    for batch in slices(batches):
        texts, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out, spans = [], []
        for text, found in zip(texts, marks, strict=True):
            runs = _spans(found or [], words_least)
            data, cuts = (text or "").encode(), []
            if runs:
                _, first, _, _ = cut_words([data])
                edges = np.append(first, len(data)).tolist()
                cuts = [(edges[a], edges[b + 1], words, row) for a, b, words, row in runs]
                kept, at = [], 0
                for a, b, _, _ in cuts:
                    kept.append(data[at:a])
                    at = b
                text = b"".join([*kept, data[at:]]).decode()
            out.append(text)
            spans.append([{"start": a, "end": b, "n_words": w, "first": r} for a, b, w, r in cuts])
        yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(out, pa.string()), pa.array(spans, kind)], ["row", "text", "spans"])


def remove_repeats(docs: DataFrame, words_least: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` as ``row``, its ``text`` without repeated passages, and the removed ``spans``.

    A span has its bytes (start, end), words, and the row number (see ``numbered``) of the first place of its first chunk. The
    first place is the one in the smallest doc_id, then the earliest in the text. A NULL text stays NULL; a text shorter than
    ``words_least`` words keeps everything. Repeated equal rows are one document, treated alike. Other columns travel in ``row``. An
    empty table gives no rows.

    Chunk digests are counted with sums made before the shuffle, so a passage that a third of all rows hold costs one row
    per task; the join back to the chunks is a plain equi-join over stored counts, which adaptive execution splits.
    """
    rows = numbered(docs)
    texts = rows.select("rid", F.col("row.text").alias("text"), "many")
    # Rows that share a number have one text, which is chunked once, however many they are.
    once = texts.filter("many").groupBy("rid").agg(F.max("text").alias("text"))
    parts = mapped(texts.filter("NOT many").select("rid", "text").unionByName(once), _chunks, CHUNKS)
    counts = parts.groupBy("h1", "h2").agg(F.min("rid").alias("first"), F.count("*").alias("n"))
    repeated = cut(counts.filter("n > 1").select("h1", "h2", "first"), "chunk-counts")
    marked = parts.join(repeated, ["h1", "h2"]).filter("rid <> first OR again").select("rid", F.struct("place", "first").alias("mark"))
    marks = cut(marked.groupBy("rid").agg(F.collect_list("mark").alias("marks")), "chunk-marks")
    whole = rows.join(marks, "rid", "left").select(F.col("row.text").alias("text"), "marks", "row")
    return mapped(whole, lambda b: _removed(b, words_least), StructType([rows.schema["row"], *StructType.fromDDL(REMOVED).fields]))


def repeated_passages(docs: DataFrame, words_least: int = MIN_WORDS) -> DataFrame:
    """A row for every passage that was removed: doc_id, first_doc_id (where it stays; NULL if that row's doc_id is NULL or
    belongs to another text too), start_byte, end_byte, n_words, and the document's remaining characters."""
    found = remove_repeats(docs, words_least).select(F.col("row.doc_id").alias("doc_id"), F.char_length("text").cast("long").alias("kept_chars"), F.explode("spans").alias("s"))
    first: Column = F.when(F.col("s.first") < _LATER, F.col("s.first"))
    return found.select("doc_id", first.alias("first_doc_id"), F.col("s.start").alias("start_byte"), F.col("s.end").alias("end_byte"), F.col("s.n_words").alias("n_words"), "kept_chars")


def without_repeats(docs: DataFrame, words_least: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut out of ``text``; a document that is left without a word goes.

    ``n_chars``, where there is one, is counted anew for changed texts.
    """
    found = remove_repeats(docs, words_least)
    changed = F.size("spans") > 0
    columns = []
    for name in docs.columns:
        value = F.col("row").getField(name)
        if name == "text":
            value = F.col("text")
        elif name == "n_chars":
            value = F.when(changed, F.char_length("text")).otherwise(value).cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return found.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*columns)
