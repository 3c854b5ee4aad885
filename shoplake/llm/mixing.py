"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words by weight. A source is repeated ``epochs`` times at most: one that would get more is clamped
there and its excess goes to the others by weight, until none is above. Every document is then taken as many whole times as its
source's ratio of target to size holds, and once more if a seeded draw takes it for the fraction that is left.
"""

from __future__ import annotations

from math import inf

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import cut, ship

#: Fixed value: a word of a text.
WORD = r"[^\x20\x09-\x0D]+"

#: A draw is a place on a line of 2**60 points, and a second one that parts rows equal in every column. Places are read in digits.
PLACE_BITS, DIGIT_BITS = 60, 12
DIGITS = PLACE_BITS // DIGIT_BITS
#: Around the place where a source's fraction is full, this many documents compete for the last words: they bound a task's rows,
#: not what is taken.
FEWEST, MOST = 1000, 4096


def sized(docs: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, source, size in words and the seeded place of every row, stored; texts are read once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    drawn = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text, F.col("source").cast("string"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.shiftrightunsigned(drawn, 64 - PLACE_BITS).alias("u"),
        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - PLACE_BITS).alias("v"),
    )
    return cut(rows, "mix-sizes")


def source_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"))


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with ``rank`` from 0, by code point, NULL last: sorted in ranges, each numbered from where the one before ends."""
    order = F.col("source").asc_nulls_last()
    sorted_ = sources.repartitionByRange(order).sortWithinPartitions(order)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = cut(sorted_.withColumns({"_part": F.spark_partition_id(), "_row": row}), "mix-sources")
    # One row for each task that sorted, so it is safe to send to all.
    parts = placed.groupBy("_part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("_part", before.alias("_before"))
    return placed.join(F.broadcast(starts), "_part").withColumn("rank", F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def _fraction(level: float) -> tuple[Column, Column]:
    """Whether a source is clamped while ``level`` words go to a weight of one, and its cap."""
    cap = F.col("cap")
    return F.lit(level) * F.col("weight") >= cap, cap


def water_fill(sources: DataFrame, share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """Adds ``target``, words as double, to sources with ``source_size`` and ``weight`` (0 or more).

    ``share`` times all words are dealt out. A round clamps what the present level lifts above its cap and deals the rest anew
    over the others, which lifts the level; when a round clamps no more, all targets are feasible. The level only rises, and
    like Newton's method on the concave curve of words against level it needs few rounds. A round is one aggregate over the
    sources. If all are clamped, targets are the caps.
    """
    sources = sources.withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    first = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    total, level, clamped = share * (first["words"] or 0), 0.0, -1
    while True:
        above, cap = _fraction(level)
        now = sources.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, cap)).alias("full"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if now["n"] == clamped:
            break
        clamped, weight = now["n"], now["weight"] or 0
        level = (total - (now["full"] or 0)) / weight if weight else inf
    above, cap = _fraction(level)
    return sources.withColumn("target", F.when(above, cap).otherwise(F.lit(level) * F.col("weight"))).drop("cap")


# --- which documents the fraction takes --------------------------------------------------------------------------------
def _prefix(level: int) -> tuple[Column, Column]:
    """A row's place cut to its first ``level`` digits."""
    if level <= DIGITS:
        return F.shiftright("u", PLACE_BITS - DIGIT_BITS * level), F.lit(0).cast("long")
    return F.col("u"), F.shiftright("v", PLACE_BITS - DIGIT_BITS * (level - DIGITS))


def _bound(level: int, at: Column, u: Column) -> tuple[Column, Column]:
    """The first place of a cell that ``level`` digits name."""
    if level <= DIGITS:
        return F.shiftleft(at, PLACE_BITS - DIGIT_BITS * level), F.lit(0).cast("long")
    return u, F.shiftleft(at, PLACE_BITS - DIGIT_BITS * (level - DIGITS))


def _windows(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each source with a fraction, the places below which all documents are taken, the window in which they compete, and
    the words that are left for it (``source``, ``left``, ``lo_u``, ``lo_v``, ``hi_u``, ``hi_v``).

    Words are summed by the places' first digit, then, where a full cell has too many documents, by the next digit inside it.
    Sums are taken before they are shuffled, and the documents themselves are not.
    """
    found, zero = None, F.lit(0).cast("long")
    state = wanted.select("source", "left", zero.alias("pu"), zero.alias("pv"))
    for level in range(2 * DIGITS):
        pu, pv = _prefix(level)
        u_next, v_next = _prefix(level + 1)
        at = (u_next if level < DIGITS else v_next).alias("cell")
        s = state.select(F.col("source").alias("_source"), "left", F.col("pu").alias("_pu"), F.col("pv").alias("_pv"))
        match = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_pu") == pu) & (F.col("_pv") == pv)
        inside = rows.join(s, match).select("source", "left", F.col("_pu").alias("pu"), at, "size")
        cells = inside.groupBy("source", "left", "pu", "cell").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        # At most 4,096 cells of a source.
        by_place = Window.partitionBy("source").orderBy("cell")
        cells = cells.withColumn("upto", F.sum("words").over(by_place))
        crossing = F.min(F.when(F.col("upto") > F.col("left"), F.col("cell"))).over(Window.partitionBy("source"))
        cells = cells.withColumn("full", crossing).filter("cell >= full")
        seen = F.coalesce(F.sum("n").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        large = F.coalesce(F.max("n").over(by_place.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) > MOST
        cells = cells.withColumns({"seen": seen, "large": large})
        first = F.col("cell") == F.col("full")
        cells = cells.filter(first | ((F.col("seen") < FEWEST) & ~F.col("large")))
        by_source = cells.groupBy("source").agg(
            F.max(F.when(first, F.col("left") - (F.col("upto") - F.col("words")))).alias("left"),
            F.max(F.when(first, F.col("n"))).alias("n"),
            F.max("pu").alias("pu"),
            F.min("cell").alias("cell"),
            F.max("cell").alias("last"),
        )
        state = cut(by_source, "mix-cells")
        done = state.filter(F.col("n") <= MOST) if level + 1 < 2 * DIGITS else state
        lo, hi = _bound(level + 1, F.col("cell"), F.col("pu")), _bound(level + 1, F.col("last") + 1, F.col("pu"))
        done = done.select("source", "left", lo[0].alias("lo_u"), lo[1].alias("lo_v"), hi[0].alias("hi_u"), hi[1].alias("hi_v"))
        found = done if found is None else found.unionByName(done)
        state = state.filter(F.col("n") > MOST)
        if state.isEmpty():
            break
        # The digits so far name the cell; once those of u are read, u itself does.
        state = state.select("source", "left", ("cell" if level < DIGITS else "pu"), "cell")
        state = state.toDF("source", "left", "pu", "cell").withColumn("pv", F.col("cell") if level >= DIGITS else zero).drop("cell")
    return found


def first_fit(group: pd.DataFrame) -> pd.DataFrame:
    """Documents of a window in seeded order, each taken once more if it fits what is left; then the one that comes nearest."""
    group = group.sort_values(["u", "v"], kind="stable")
    sizes, left = group["size"].to_numpy(), float(group["left"].iloc[0]) if len(group) else 0.0
    taken = np.zeros(len(sizes), bool)
    for k, size in enumerate(sizes.tolist()):
        if size <= left:
            taken[k], left = True, left - size
    rest = np.flatnonzero(~taken)
    if len(rest):
        best = rest[np.argmin(np.abs(sizes[rest] - left))]
        taken[best] = abs(sizes[best] - left) < left
    repeats = group["whole"].to_numpy() + taken
    return pd.DataFrame(
        {"doc_id": group["doc_id"], "size": sizes, "source_size": group["source_size"], "target": group["target"], "taken": sizes * repeats}
    )


MIXED = "doc_id long, size long, source_size long, target double, taken long"


def mix(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """How many words of every document the mix takes, repeats counted.

    ``rows`` are those of ``sized``; ``targets`` has source, source_size and target, at most ``epochs`` times the size. A source's
    taken words differ from its target by less than its shortest documents around the last one taken, or by half a document
    where it has a few only. The draw depends on the seed and on doc_id, text and source, not on how rows are dealt over tasks.
    """
    ship(rows.sparkSession)
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    planned = targets.select("source", "source_size", "target", ratio.alias("whole"))
    planned = planned.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    planned = cut(planned, "mix-targets")
    windows = _windows(rows, planned.filter("left > 0").select("source", "left"))
    w = windows.select(F.col("source").alias("_source"), F.col("left").alias("_left"), "lo_u", "lo_v", "hi_u", "hi_v")
    plan = planned.drop("left").join(w, F.col("source").eqNullSafe(F.col("_source")), "left")
    # Stored, so that its size is known when the join is planned: it is sent to all tasks only below Spark's threshold.
    plan = cut(plan.drop("_source").withColumnRenamed("source", "_source").withColumnRenamed("_left", "left"), "mix-plan")
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    here = F.struct("u", "v")
    below = F.coalesce(here < F.struct(F.col("lo_u").alias("u"), F.col("lo_v").alias("v")), F.lit(False))
    under = F.coalesce(here < F.struct(F.col("hi_u").alias("u"), F.col("hi_v").alias("v")), F.lit(False))
    outside = placed.filter(below | ~under).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("whole") + below.cast("long"))).alias("taken")
    )
    compete = placed.filter(~below & under).groupBy("source").applyInPandas(first_fit, MIXED)
    return outside.unionByName(compete)


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = 11) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row of ``docs`` (doc_id, text, source; other columns are not read).

    Sources by code point, NULL last, get ``weights`` in turn. A NULL or empty text has size 0 and is taken 0 times; rows with equal
    columns are rows of their own, of which any may be the ones taken. A source without words has target 0. An empty table
    gives an empty result. A text of any length is one row of numbers after it was read.
    """
    rows = sized(docs, seed)
    order = ranked(source_sizes(rows))
    dealt = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    targets = water_fill(cut(order.withColumn("weight", dealt), "mix-weights"), share, epochs)
    return mix(rows, targets)
