"""Joins that stay balanced when one key, or NULL, holds a large share of the rows.

Adaptive execution splits skewed partitions only where both join inputs are plain shuffles. The joins of the
star schema are mostly against an aggregate, which it leaves alone, so heavy keys are found first (one pass with a
bounded sketch) and routed around the shuffle. Without heavy keys the plain join is planned.

Settings: ``shoplake.skew.minRows`` (a key with fewer rows is never heavy), ``shoplake.skew.rowsPerTask`` (a heavy key is cut into as
many slices as keep one task to that many rows), ``shoplake.skew.ways`` (but into that many at least). The limit is a number of rows and does not
rise with the table; ``shoplake.skew.share`` may add one that does, and is off unless set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

MIN_ROWS = "shoplake.skew.minRows"
SHARE = "shoplake.skew.share"
ROWS_PER_TASK = "shoplake.skew.rowsPerTask"
# Slices that a heavy key is cut into at least.
WAYS = "shoplake.skew.ways"

# Of 20,000 keys with 5,000,000 rows each, which is 10**11 rows, the sketch still tells each one apart.
MAX_HEAVY = 20_000
SKETCH_ITEMS = 65_536
SEEN = 50_000


def _setting(df: DataFrame, name: str, default: float) -> float:
    return float(df.sparkSession.conf.get(name, str(default)))


def heavy_counts(df: DataFrame, *keys: Column | str, min_rows: int | None = None) -> list[dict[Any, int]]:
    """For each key expression, the values (NULL included) that hold too many rows for one task, with about how many they hold.

    One job for all keys. A frequent-item sketch keeps a fixed number of entries per key, never underestimates a
    count, and merges without shuffling the keys; at most ``MAX_HEAVY`` values come back. Only statistics are
    gathered here, so a share of the rows is enough: as many as show a key of ``minRows`` rows ``SEEN`` times, give or
    take half a percent. Missing or adding a borderline key changes the plan, not the result. ``min_rows`` takes the place of the settings.
    """
    return counted(df, *keys, min_rows=min_rows)[0]


def counted(df: DataFrame, *keys: Column | str, min_rows: int | None = None, exact: bool = False) -> tuple[list[dict[Any, int]], int]:
    """``heavy_counts``, and about how many rows there are in all, from the same job. With ``exact`` it counts all rows, and only the
    sketches see a share."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    names = [f"_key{i}" for i in range(len(columns))]
    sketches = [F.expr(f"approx_top_k({n}, {MAX_HEAVY}, {SKETCH_ITEMS})").alias(n) for n in names]
    share = 0.0 if min_rows else _setting(df, SHARE, 0)
    min_rows = min_rows or max(_setting(df, MIN_ROWS, 5_000_000), 1)
    part = min(1.0, SEEN / min_rows)
    picked = df.select(*(c.alias(n) for c, n in zip(columns, names)))
    if exact and part < 1:
        picked = picked.withColumn("_dice", F.rand(7))
        sketches = [F.expr(f"approx_top_k({n}, {MAX_HEAVY}, {SKETCH_ITEMS}) FILTER (WHERE _dice < {part})").alias(n) for n in names]
    elif part < 1:
        picked = picked.sample(part, seed=7)
    row = picked.agg(F.count(F.lit(1)).alias("_rows"), *sketches).first()
    if exact:
        limit = max(min_rows * part, share * row["_rows"] * part)
    else:
        limit = max(min_rows * part, share * row["_rows"])
    found = [{entry["item"]: ceil(entry["count"] / part) for entry in row[n] or [] if entry["count"] > limit} for n in names]
    return found, row["_rows"] if exact else ceil(row["_rows"] / part)


def heavy_keys(df: DataFrame, *keys: Column | str) -> list[list[Any]]:
    """``heavy_counts`` without the counts."""
    return [list(found) for found in heavy_counts(df, *keys)]


def slices_of(df: DataFrame, counts: Mapping[Any, int]) -> dict[Any, int]:
    """How many slices each heavy key is cut into."""
    rows, least = max(_setting(df, ROWS_PER_TASK, 5_000_000), 1), int(_setting(df, WAYS, 8))
    return {value: max(least, ceil(count / rows)) for value, count in counts.items()}


def is_any(key: Column, values: Sequence[Any]) -> Column:
    """Never-NULL membership test that also matches a NULL listed in ``values``."""
    known = [v for v in values if v is not None]
    test = F.coalesce(key.isin(known), F.lit(False)) if known else F.lit(False)
    return test | key.isNull() if len(known) < len(values) else test


def _with_ways(df: DataFrame, key: str, ways: Mapping[Any, int], name: str) -> DataFrame:
    """``df`` with the number of slices of each row's key; the map has at most ``MAX_HEAVY`` rows, so every task gets it."""
    schema = StructType([StructField("_heavy", df.schema[key].dataType), StructField(name, LongType())])
    small = df.sparkSession.createDataFrame([*ways.items()], schema)
    joined = df.join(F.broadcast(small), F.col(key).eqNullSafe(F.col("_heavy")), "left").drop("_heavy")
    return joined.withColumn(name, F.coalesce(name, F.lit(1).cast("long")))


def _slice(columns: Sequence[str], ways: Column) -> Column:
    # The partition number separates identical rows; unlike a random number or row counter it does not depend on
    # the order of rows within a partition, so a recomputed task assigns the same slices.
    return F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), ways)


def _cut(df: DataFrame, key: str, ways: Mapping[Any, int], name: str) -> DataFrame:
    """Rows of heavy keys dealt over their slices; all others are in slice 0."""
    if not ways:
        return df.withColumn(name, F.lit(0).cast("long"))
    columns = df.columns
    return _with_ways(df, key, ways, "_ways").withColumn(name, _slice(columns, F.col("_ways"))).drop("_ways")


def _copied(df: DataFrame, key: str, ways: Mapping[Any, int], name: str) -> DataFrame:
    """A copy of a row for each slice that its key has on the other side. A NULL key matches nothing and is not copied."""
    known = {value: n for value, n in ways.items() if value is not None}
    if not known:
        return df.withColumn(name, F.lit(0).cast("long"))
    counted = _with_ways(df, key, known, "_ways")
    return counted.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_ways") - 1))).drop("_ways")


def enrich(left: DataFrame, rights: Sequence[DataFrame], key: str, heavy: Sequence[Any] | None = None) -> DataFrame:
    """Left-join tables that hold at most one row per ``key`` (dimension rows or per-key aggregates).

    Heavy keys are cut into slices on the left, and the one right row of each is copied for every slice, so all
    inputs are read once. Copies number as many as slices, which the rows of the left bound. Finding heavy keys is a job that
    runs while the frame is built, unless ``heavy`` names them.
    """
    if heavy is None:
        (counts,) = heavy_counts(left, key)
    else:
        counts = dict.fromkeys(heavy, 0)
    if not counts:
        for table in rights:
            left = left.join(table, key, "left")
        return left
    ways = slices_of(left, counts)
    made, names = _cut(left, key, ways, "_slice"), [key, "_slice"]
    for table in rights:
        # Copies are distinct as they are; saying so lets Spark leave out a join of which no column is wanted. It costs no shuffle of
        # its own, as the join needs the same one.
        made = made.join(_copied(table, key, ways, "_slice").dropDuplicates(names), names, "left")
    return made.drop("_slice")


def sliced(left: DataFrame, right: DataFrame, key: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a column ``name`` to join on as well: keys heavy on the left are cut into slices there, and each of their
    right rows is copied for every slice. Meant for a right side with few rows to a key."""
    (counts,) = heavy_counts(left, key)
    ways = slices_of(left, counts)
    return _cut(left, key, ways, name), _copied(right, key, ways, name)


def scatter_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", search: bool = True) -> DataFrame:
    """Left or inner equi-join in which ``key`` may repeat on both sides.

    Keys heavy on the left are cut into slices there and copied per slice on the right; keys heavy on the right
    the other way round. Every matching pair meets in exactly one pair of slices, and each input is read once. A left row that is
    copied, because its key is heavy on the right, has its match in some slice; where it meets none, it is not kept
    as unmatched. ``search=False`` is for inputs known to have no heavy keys. Finding them is a job on either side that runs while
    the frame is built.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    if not search:
        return left.join(right, key, how)
    with ThreadPoolExecutor(2) as pool:
        (left_counts,), (right_counts,) = pool.map(lambda side: heavy_counts(side, key), (left, right))
    left_ways = slices_of(left, left_counts)
    right_ways = slices_of(right, {value: n for value, n in right_counts.items() if value is not None})
    if not left_ways and not right_ways:
        return left.join(right, key, how)
    names = [key, *(n for n, used in (("_slice", left_ways), ("_part", right_ways)) if used)]
    l_side, r_side = left, right
    if left_ways:
        l_side, r_side = _cut(l_side, key, left_ways, "_slice"), _copied(r_side, key, left_ways, "_slice")
    if right_ways:
        l_side, r_side = _copied(l_side, key, right_ways, "_part"), _cut(r_side, key, right_ways, "_part")
    if not right_ways or how == "inner":
        return l_side.join(r_side, names, how).drop("_slice", "_part")
    copied = _with_ways(l_side, key, right_ways, "_copies").withColumn("_copy", F.col("_copies") > 1).drop("_copies")
    met = copied.join(r_side.withColumn("_met", F.lit(True)), names, how)
    return met.filter(F.col("_met") | ~F.col("_copy")).drop("_slice", "_part", "_met", "_copy")


def key_code(keys: Sequence[str]) -> Column:
    """One value standing for a (possibly composite) key. A hash clash only makes one more key count as heavy."""
    return F.col(keys[0]) if len(keys) == 1 else F.xxhash64(*keys)


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def cut_points(df: DataFrame, keys: Sequence[str], ts: str, pieces: int) -> DataFrame:
    """Per key, the instants that cut its rows into ``pieces`` time ranges of similar size.

    Meant for a frame reduced to heavy keys: the result has at most ``MAX_HEAVY`` rows. It is fetched once and
    handed back as constants because approximate percentiles may differ when a plan evaluates them twice.
    """
    shares = F.array(*(F.lit(i / pieces) for i in range(1, pieces)))
    found = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys)
        .agg(F.array_sort(F.array_distinct(F.percentile_approx(_micros(ts), shares, F.lit(10_000)))).alias("_cuts"))
    )
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def time_range(ts: str) -> Column:
    """Number of the time range a row falls into, given its key's ``_cuts``; NULL instants come first."""
    inside = F.size(F.filter("_cuts", lambda cut: cut <= _micros(ts)))
    return F.when(F.col(ts).isNull(), F.lit(-1)).otherwise(inside)
