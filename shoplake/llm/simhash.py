"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints within ``distance`` bits, cut into m partitions with thresholds that add up to ``distance - m + 1``, must agree
within the threshold in at least one partition (a threshold of -1 leaves a partition out). Partitions are groups of correlated bits, fitted
together with their thresholds on a bounded sample of fingerprints; the choice decides the work, never the result.
Every fingerprint is indexed once for each partition, probes the values within the threshold, and meetings are verified on all
bits. Values that very many fingerprints share are not paired: their probers are linked through their common
neighbours at one bit's distance, whose groups hold ``1 + bits`` fingerprints at most.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import cut, mapped, packed_rows, slices, text_key, texts_of
from shoplake.llm.components import components

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 2

#: Fingerprints the partitions are fitted on: those with the smallest hashes. The fit only steers the work.
SAMPLE = 10_000
#: A partition value that more fingerprints share is linked through common neighbours instead of pairs.
CROWD = 128


# --- fingerprints -------------------------------------------------------------------------------------------------------
def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits; one is set if it is set in over half of the shingles' XXH64 values. A text without a word gives 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # a very long text a part at a time
        counts += np.unpackbits(values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found)], ["doc_id", "tie", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tie (a hash of the text) and fp (the fingerprint as a signed long) of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("tie"))
    return mapped(rows, lambda b: _fingerprints(b, shingle), "doc_id long, tie long, fp long")


# --- partitions ---------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Partition:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        """The partition's bits as a signed long."""
        value = sum(1 << b for b in self.bits)
        return value - (1 << BITS) if value >> (BITS - 1) else value

    def flips(self) -> list[int]:
        """What turns a value into those within the threshold, itself first."""
        out = [0]
        for k in range(1, self.threshold + 1):
            out += [sum(1 << b for b in some) for some in itertools.combinations(self.bits, k)]
        return [f - (1 << BITS) if f >> (BITS - 1) else f for f in out]


def group_bits(bits: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits in ``parts`` groups of about equal size, each grown by the bit most correlated with those it has."""
    with np.errstate(all="ignore"):
        near = np.abs(np.nan_to_num(np.corrcoef(bits.T))) if len(bits) > 1 else np.zeros((BITS, BITS))
    free, out = list(range(BITS)), []
    for part in range(parts):
        size = len(free) // (parts - part)
        rest = near[np.ix_(free, free)].sum(axis=1)
        group = [free.pop(int(rest.argmax()))]
        while len(group) < size:
            group.append(free.pop(int(near[np.ix_(free, group)].sum(axis=1).argmax())))
        out.append(tuple(sorted(group)))
    return out


def _close_share(values: np.ndarray, bits: tuple[int, ...], threshold: int) -> float:
    """The estimated share of pairs that agree within the threshold on some bits."""
    if threshold < 0:
        return 0.0
    mask = np.uint64(sum(1 << b for b in bits))
    kept, counts = np.unique(values & mask, return_counts=True)
    pairs = float((counts * (counts - 1)).sum())
    for k in range(1, threshold + 1):
        for some in itertools.combinations(bits, k):
            other = kept ^ np.uint64(sum(1 << b for b in some))
            at = np.minimum(np.searchsorted(kept, other), len(kept) - 1)
            pairs += float((counts * counts[at])[kept[at] == other].sum())
    even = sum(math.comb(len(bits), k) for k in range(threshold + 1)) / 2.0 ** len(bits)
    return max(pairs / max(1.0, len(values) * (len(values) - 1.0)), even)


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (-1 and up) that add up to ``total`` at the least cost; ``costs[i][t + 1]`` is partition i's cost at t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for slot, extra in enumerate(row):
                key = done + slot - 1
                if key not in following or cost + extra < following[key][0]:
                    following[key] = (cost + extra, [*chosen, slot - 1])
        best = following
    return best.get(total, (math.inf, []))


def fit(values: np.ndarray, n: int, distance: int = DISTANCE) -> list[Partition]:
    """Partitions and thresholds with the least estimated probes and candidate pairs for ``n`` fingerprints."""
    bits = (values[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    best: tuple[float, list[Partition]] = (math.inf, [])
    for parts in range(1, distance + 3):
        groups = group_bits(bits.astype(float), parts)
        costs = []
        for group in groups:
            row = [0.0]
            for t in range(distance + 1):
                # A probe is a shuffled row, a candidate is a comparison.
                probes = sum(math.comb(len(group), k) for k in range(t + 1))
                # More probes than common neighbours would take are never chosen.
                row.append(math.inf if probes > 8 * BITS else 20.0 * n * probes + n * (n - 1) / 2 * _close_share(values, group, t))
            costs.append(row)
        cost, thresholds = allocate(costs, distance - parts + 1)
        if cost < best[0]:
            best = (cost, [Partition(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0])
    return best[1]


def _sample(prints: DataFrame) -> tuple[np.ndarray, int]:
    some = prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    return np.array([r.fp for r in some], np.int64).view(np.uint64), prints.count()


# --- links --------------------------------------------------------------------------------------------------------------
def _value(part: Partition, flip: int = 0) -> Column:
    return F.col("fp").bitwiseAND(F.lit(part.mask)).bitwiseXOR(F.lit(flip))


def _keyed(prints: DataFrame, values: list[tuple[int, list[Column]]]) -> DataFrame:
    """A row for each partition number and value."""
    keys = [F.struct(F.lit(i).alias("part"), v.alias("value")) for i, found in values for v in found]
    return prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.part", "k.value")


def links(prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) that connect all fingerprints within ``distance`` bits; ``prints`` has distinct ones as ``fp``.

    Every pair within the distance is a link or, among the probers of a crowded value, joined by two links or a chain.
    ``distance`` is at most 2, as the common neighbours are those one bit away.
    """
    if not 0 <= distance <= 2:
        raise ValueError("the distance is 0, 1 or 2")
    values, n = _sample(prints)
    parts = fit(values, n, distance)
    index = cut(_keyed(prints, [(i, [_value(p)]) for i, p in enumerate(parts)]), "simhash-index")
    probes = _keyed(prints, [(i, [_value(p, f) for f in p.flips()]) for i, p in enumerate(parts)]) if any(p.threshold for p in parts) else index
    crowded = cut(index.groupBy("part", "value").count().filter(F.col("count") > crowd).select("part", "value"), "simhash-crowded")

    sparse_index = index.join(crowded, ["part", "value"], "left_anti")
    sparse_probes = probes.join(crowded, ["part", "value"], "left_anti")
    met = sparse_index.withColumnRenamed("fp", "u").join(sparse_probes.withColumnRenamed("fp", "v"), ["part", "value"])
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    pairs = met.filter((F.col("u") < F.col("v")) & close).select("u", "v").distinct()

    # Both ends of a pair that meets at a crowded value probe that value, so both are here. At distance 2 two fingerprints share
    # a neighbour one bit from each; at distance 1 or less they are neighbours themselves.
    dense = probes.join(crowded, ["part", "value"], "left_semi").select("fp").distinct()
    masks = F.lit([0] + [1 << b for b in range(BITS - 1)] + [-(1 << (BITS - 1))]).cast("array<bigint>")
    if distance == 2:
        near = dense.select("fp", F.explode(masks).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point"))
        groups = near.groupBy("point").agg(F.sort_array(F.collect_list("fp")).alias("fps")).filter(F.size("fps") > 1)
        chained = groups.select(F.explode(F.slice("fps", 2, BITS)).alias("u"), F.col("fps")[0].alias("v"))
    elif distance == 1:
        near = dense.select("fp", F.explode(masks).alias("m")).select(F.col("fp").alias("v"), F.col("fp").bitwiseXOR(F.col("m")).alias("fp"))
        chained = near.join(dense, "fp").select(F.col("fp").alias("u"), "v").filter("u < v")
    else:
        chained = pairs.limit(0)
    return pairs.unionByName(chained)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, tie, fp, root and component_id of every row. ``root`` is the component's smallest fingerprint, component_id the smallest doc_id reachable over links of ``distance`` bits or fewer.

    Words, shingles and bits are as the contract has them (A-Z lower-cased; white space is blank and \\x09-\\x0D). A NULL or empty
    text has fingerprint zero and is linked like any other. Equal fingerprints are one node, so a group of copies of any size
    costs one. A row whose doc_id is NULL takes part; its component_id is the smallest other doc_id, or NULL where there is
    none. Repeated rows each come back. Other columns are not read. An empty table gives no rows.
    """
    rows = cut(fingerprints(docs, shingle), "simhash-rows")
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    roots = cut(components(links(prints.select("fp"), distance)), "simhash-roots")
    grouped = prints.join(roots, prints.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = cut(grouped.join(smallest, "root").select("fp", "root", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", "tie", "fp", "root", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: the first by doc_id (NULL last), then by a hash of the text.

    Rows that agree in doc_id and text are one document; of those the one with the least columns, written as JSON, stays.
    """
    rows = cut(near_duplicates(docs, shingle, distance), "simhash-components")
    counted = rows.groupBy("root", "doc_id", "tie").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "tie", "n")
    first = counted.groupBy("root").agg(F.min(order).alias("x"))
    kept = cut(first.select(F.col("x.doc_id").alias("_doc"), F.col("x.tie").alias("_tie"), F.col("x.n").alias("_n")), "simhash-kept")
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("tie") == F.col("_tie"))
    found, several = packed_rows(docs).join(kept, same), F.col("_n") > 1
    out = found.filter(~several).select("row")
    if not kept.filter(several).isEmpty():
        # Copies are reduced before they are shuffled.
        least = found.filter(several).groupBy("doc", "tie").agg(F.min_by("row", F.to_json("row")).alias("row"))
        out = out.unionByName(least.select("row"))
    return out.select("row.*")
