"""Connected components of a graph in distributed rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that can be reached, for every node of ``edges`` (u, v; longs, not NULL).

    Rounds of two steps until nothing changes: every node links its larger neighbours to its smallest one, then its smaller
    neighbours and itself to the smallest of them. The number of links never grows; a chain of n nodes takes about log n
    rounds. Minima are taken before they are shuffled; the joins that carry them back are plain equi-joins, which adaptive
    execution splits at a node with very many links. Each round's links are stored, so a lost executor costs no earlier round.
    """
    links = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while (now := _state(links)) != before and now[0]:
        before = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("u", F.least("u", "m").alias("m"))
        # Each link is kept once, at its smaller end, which knows its smallest neighbour.
        large = links.select(F.col("v").alias("u"), F.col("u").alias("other")).join(least, "u").select(F.col("other").alias("u"), F.col("m").alias("v"))
        large = cut(large.filter("u <> v").distinct(), "links-large")
        small = large.join(_least(large), "u")
        moved = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        links = cut(moved.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).filter("u <> v").distinct(), "links-small")
    # Every node but the roots has exactly one link now, to its root.
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
