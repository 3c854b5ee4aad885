"""Current-state upsert, versioned history and point-in-time lookup."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shoplake.config import METADATA
from shoplake.operators.dedup import CHANGED, INGESTED, LOADED, change_time, keep_latest_known, precedence, time_order
from shoplake.operators.skew import counted, cut_points, heavy_counts, is_any, key_code, sliced, slices_of, time_range

START, END = "__start_date", "__end_date"
#: Kept beside a stored history's columns: whether a row opens a version, and whether it no longer counts.
SHOWN, GONE = "_shown", "_gone"
MARKS = (START, END, SHOWN, GONE, "_was")
#: Time ranges of a heavy key: at least so many, and at most as the percentiles behind them can tell apart.
PIECES, MOST_PIECES = 64, 4096
#: Versions of a key up to which facts are joined with all of them.
FEW_VERSIONS = 64
#: Rows that one task lines up, where no key alone has more.
SORTED_ROWS = 200_000
#: Before any time; rows without a time come first.
NEVER = dt.datetime(1, 1, 1)


def scd1(base: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str = INGESTED) -> DataFrame:
    """Upsert: after both inputs are put together the newest row of each key wins. Rows without a complete key all stay."""
    return keep_latest_known(base.unionByName(changes, allowMissingColumns=True), keys, ts)


def _split(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key fits one task, laid out by key, and the rows of heavy keys, if any.

    Rows of a log resemble each other and are packed to a small part of their size while they are shuffled, so tasks of even packed
    size would each sort more rows than their memory holds. The number of tasks follows the rows instead.
    """
    (heavy,), rows = counted(df, key_code(keys), exact=True)
    picked = is_any(key_code(keys), list(heavy))
    usual = df.filter(~picked) if heavy else df
    if rows > SORTED_ROWS:
        usual = usual.repartition(max(ceil(rows / SORTED_ROWS), df.sparkSession.sparkContext.defaultParallelism), *keys)
    return usual, df.filter(picked) if heavy else None


def _pieces(df: DataFrame) -> int:
    """How many time ranges the rows of heavy keys are cut into, so that even if all had one key a range would fit a task."""
    return min(MOST_PIECES, max(PIECES, *slices_of(df, {None: df.count()}).values()))


def _ranged(df: DataFrame, keys: Sequence[str], ts: str, cuts: DataFrame) -> DataFrame:
    # cuts has at most one row per heavy key, a bounded number, so it is safe to send to every task.
    same = [df[k].eqNullSafe(cuts[k]) for k in keys]
    joined = df.join(F.broadcast(cuts), reduce(Column.__and__, same), "left").select(df["*"], cuts["_cuts"])
    return joined.withColumn("_range", F.coalesce(time_range(ts), F.lit(0))).drop("_cuts")


def _from_neighbour(
    df: DataFrame, keys: Sequence[str], summary: Column, over: Callable[[Column], Column]
) -> DataFrame:
    """Add ``_carry``: a value taken from a key's neighbouring time ranges.

    ``summary`` reduces each range to one value; ``over`` looks across the ranges of a key. The side table
    has at most one row per heavy key and range, a bounded number.
    """
    edges = df.groupBy(*keys, "_range").agg(summary.alias("_edge"))
    edges = edges.withColumn("_carry", over(F.col("_edge"))).drop("_edge")
    names = [*keys, "_range"]
    edges = edges.select(*(F.col(n).alias(f"_e_{n}") for n in names), "_carry")
    match = reduce(Column.__and__, (df[n].eqNullSafe(edges[f"_e_{n}"]) for n in names))
    return df.join(F.broadcast(edges), match, "left").drop(*(f"_e_{n}" for n in names))


def scd2(changes: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None, ts: str = INGESTED) -> DataFrame:
    """Version history of each key, from its full change log. A change counts from when its source was written, or loaded where
    that is not known, so how many files one batch takes in makes no difference.

    Of several changes at one instant the last counts (the others would be versions of zero length), and a change that
    leaves every tracked column as it was adds no version. A version starts at its own time and ends where the
    next one starts; NULL means it is current. Late changes are placed by their own time, so feeding the whole
    log again (or the log of the touched keys) splits the interval they fall into. A backfilled row tells what was there before
    any increment, so it is a version only from a time before the key's first one; ``maintain`` keeps a stored history up.
    """
    tracked = list(tracked or tracked_columns(changes.columns, keys, ts))
    changes, ts = timed(changes, ts)
    usual, heavy = _split(changes, keys)
    result = _versions(usual, keys, tracked, ts)
    if heavy is not None:
        result = result.unionByName(_versions_in_ranges(heavy, keys, tracked, ts))
    return result


def tracked_columns(columns: Sequence[str], keys: Sequence[str], ts: str = INGESTED) -> list[str]:
    return [c for c in columns if c not in {*keys, ts, *METADATA}]


def timed(changes: DataFrame, ts: str = INGESTED) -> tuple[DataFrame, str]:
    """Changes with a column that tells when each counts from, and that column's name."""
    if ts == INGESTED and CHANGED in changes.columns:
        return changes.withColumn(CHANGED, change_time(changes.columns)), CHANGED
    return changes, ts


def _along(df: DataFrame, keys: Sequence[str], ts: str) -> list[Column]:
    names = [c for c in df.columns if c not in {*keys, *MARKS}]
    # Of equal rows a stored one comes last, so that it stays.
    held = [F.col("_was").isNotNull()] if "_was" in df.columns else []
    return [c.asc_nulls_first() for c in [*time_order(names, ts), *held]]


def _increment() -> Column:
    return precedence() == 1


def _last_at(ts: str, w: WindowSpec) -> Column:
    return F.lead(F.lit(True)).over(w).isNull() | ~F.lead(ts).over(w).eqNullSafe(F.col(ts))


def _as_version(df: DataFrame, ts: str, end: Column) -> DataFrame:
    return df.select("*", F.col(ts).alias(START), end.alias(END))


def _versions(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str) -> DataFrame:
    # All windows share one shuffle and one sort.
    w = Window.partitionBy(*keys).orderBy(*_along(df, keys, ts))
    state = F.struct(*tracked)
    kept = df
    if LOADED in df.columns:
        before = F.max(_increment()).over(w.rowsBetween(Window.unboundedPreceding, 0))
        kept = kept.withColumn("_late", before & ~_increment()).filter("NOT _late").drop("_late")
    kept = kept.withColumn("_last", _last_at(ts, w)).filter("_last").drop("_last")
    kept = kept.withColumn("_new", ~F.lag(state).over(w).eqNullSafe(state)).filter("_new").drop("_new")
    return _as_version(kept, ts, F.lead(ts).over(w))


def _versions_in_ranges(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str) -> DataFrame:
    """The same for keys too heavy for one task: time ranges are worked on side by side, then stitched."""
    single = _last_of_instant(_before_increments(df, keys, ts), keys, ts)
    ranged = _ranged(single, keys, ts, cut_points(single, keys, ts, _pieces(single)))
    w = Window.partitionBy(*keys, "_range").orderBy(F.col(ts).asc_nulls_first())
    across = Window.partitionBy(*keys).orderBy("_range")
    state = F.struct(*tracked)

    before = _from_neighbour(
        ranged.withColumn("_state", state), keys, F.max_by("_state", F.struct(ts)), lambda edge: F.lag(edge).over(across)
    )
    previous = F.coalesce(F.lag("_state").over(w), F.col("_carry"))
    kept = before.withColumn("_new", ~previous.eqNullSafe(F.col("_state"))).filter("_new").drop("_new", "_state", "_carry")

    after = _from_neighbour(kept, keys, F.min(ts), lambda edge: F.lead(edge).over(across))
    return _as_version(after, ts, F.coalesce(F.lead(ts).over(w), F.col("_carry"))).drop("_range", "_carry")


def _before_increments(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Without backfilled rows from the time of a key's first increment or later. Meant for a frame reduced to heavy keys: a row for
    each is looked up, at most ``MAX_HEAVY``, so it is safe to send to every task."""
    if LOADED not in df.columns:
        return df
    first = df.filter(_increment()).groupBy(*(F.col(k).alias(f"_f_{k}") for k in keys)).agg(F.min(F.coalesce(ts, F.lit(NEVER))).alias("_first"))
    match = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys))
    joined = df.join(F.broadcast(first), match, "left").drop(*(f"_f_{k}" for k in keys))
    live = _increment() | F.col("_first").isNull() | (F.coalesce(ts, F.lit(NEVER)) < F.col("_first"))
    return joined.filter(live).drop("_first")


def _last_of_instant(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    names = [*keys, ts]
    if not set(df.columns) - set(names):
        return df.distinct()
    held = [F.col("_was").isNotNull()] if "_was" in df.columns else []
    order = [c.desc_nulls_last() for c in [*time_order([c for c in df.columns if c not in {*keys, *MARKS}], ts), *held]]
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


# --- a history that is kept up ------------------------------------------------------------------------------------------
def _opened(df: DataFrame, ts: str) -> Column:
    return F.when(F.col(SHOWN), F.col(ts))


def _timeline(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str) -> DataFrame:
    """One row for each key and instant, also where nothing changed, with the version it lies in; rows that no longer count last."""
    w = Window.partitionBy(*keys).orderBy(*_along(df, keys, ts))
    upto, state = w.rowsBetween(Window.unboundedPreceding, 0), F.struct(*tracked)
    back = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    late = F.max(_increment()).over(upto) & ~_increment() if LOADED in df.columns else F.lit(False)
    marked = df.withColumn(GONE, late)
    live = marked.filter(~F.col(GONE)).withColumn("_last", _last_at(ts, w)).filter("_last").drop("_last")
    live = live.withColumn(SHOWN, ~F.lag(state).over(w).eqNullSafe(state))
    live = live.withColumn(START, F.last(_opened(live, ts), ignorenulls=True).over(upto))
    live = live.withColumn(END, F.last(_opened(live, ts), ignorenulls=True).over(back))
    return live.unionByName(marked.filter(F.col(GONE) & F.col("_was").isNotNull()), allowMissingColumns=True)


def _timeline_in_ranges(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str) -> DataFrame:
    """The same for keys too heavy for one task."""
    live = _before_increments(df, keys, ts)
    single = _last_of_instant(live, keys, ts)
    ranged = _ranged(single, keys, ts, cut_points(single, keys, ts, _pieces(single))).withColumn("_state", F.struct(*tracked))
    w = Window.partitionBy(*keys, "_range").orderBy(F.col(ts).asc_nulls_first())
    back = Window.partitionBy(*keys, "_range").orderBy(F.col(ts).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("_range")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)

    found = _from_neighbour(ranged, keys, F.max_by("_state", F.struct(ts)), lambda edge: F.lag(edge).over(across))
    found = found.withColumn(SHOWN, ~F.coalesce(F.lag("_state").over(w), F.col("_carry")).eqNullSafe(F.col("_state"))).drop("_carry", "_state")
    found = _from_neighbour(found, keys, F.max(_opened(found, ts)), lambda edge: F.last(edge, ignorenulls=True).over(earlier))
    inside = F.last(_opened(found, ts), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    found = found.withColumn(START, F.coalesce(inside, "_carry")).drop("_carry")
    found = _from_neighbour(found, keys, F.min(_opened(found, ts)), lambda edge: F.last(edge, ignorenulls=True).over(later))
    inside = F.last(_opened(found, ts), ignorenulls=True).over(back)
    found = found.withColumn(END, F.coalesce(inside, "_carry")).drop("_carry", "_range").withColumn(GONE, F.lit(False))
    if LOADED not in df.columns:
        return found
    names = [*keys, ts]
    # A row in whose place another of its time came is replaced by that one.
    kept = found.select(*(F.col(c).alias(f"_k_{c}") for c in names))
    match = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in names))
    gone = df.filter(F.col("_was").isNotNull() & ~_increment()).join(kept, match, "left_anti").withColumn(GONE, F.lit(True))
    return found.unionByName(gone, allowMissingColumns=True)


def maintain(stored: DataFrame, changes: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None, ts: str = INGESTED) -> DataFrame:
    """What a batch of changes alters in a stored history: rows to be put in place of those with their key and time.

    ``stored`` has a row for each key and time at which something was reported, the columns of ``changes``, and the version the row
    lies in: its start and end, and whether the row opens it (``SHOWN``). Rows that report nothing new are kept too, since a late
    change before them may make a version of them. Of the stored rows, only those of the batch's keys from the version that holds the key's
    earliest change on take part; a late change splits that version, and what changes neither by value nor by version is not
    returned. Rows with ``GONE`` no longer count. ``versions`` of the result equal ``scd2`` of the whole log. A batch that is fed
    twice returns nothing the second time.
    """
    changes, ts = timed(changes, ts)
    tracked = list(tracked or tracked_columns(changes.columns, keys, ts))
    bounds = changes.groupBy(*(F.col(k).alias(f"_b_{k}") for k in keys)).agg(
        F.when(F.max(F.col(ts).isNull()), None).otherwise(F.min(ts)).alias("_lo")
    )
    match = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys))
    reach = F.col(END).isNull() | F.col("_lo").isNull() | (F.col(END) >= F.col("_lo"))
    was = F.struct(START, END, SHOWN).alias("_was")
    near = stored.join(bounds, match & reach).select(*changes.columns, was)
    kind = near.schema["_was"].dataType
    lined_up = near.unionByName(changes.withColumn("_was", F.lit(None).cast(kind)))
    usual, heavy = _split(lined_up, keys)
    found = _timeline(usual, keys, tracked, ts)
    if heavy is not None:
        found = found.unionByName(_timeline_in_ranges(heavy, keys, tracked, ts), allowMissingColumns=True)
    return found.filter(F.col("_was").isNull() | F.col(GONE) | ~F.col("_was").eqNullSafe(F.struct(START, END, SHOWN))).drop("_was")


def versions(stored: DataFrame) -> DataFrame:
    """The versions of a stored history, as ``scd2`` gives them."""
    kept = [c for c in stored.columns if c not in MARKS]
    return stored.filter(SHOWN).select(*kept, START, END)


def as_of(facts: DataFrame, history: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Attach to each fact the version that was valid at its time ``at`` (start <= at < end), or NULLs.

    Facts meet the versions of their key in a join whose range is checked as rows meet; facts of a heavy key are cut into slices. A key with
    more than ``FEW_VERSIONS`` would form too many pairs: its facts and versions are lined up by time in one sort, and the last
    version seen is carried forward. Versions of a key must not overlap, as those of ``scd2`` don't. History columns that facts also
    have (keys excepted) must be renamed first. Two jobs that look for such keys run while the frame is built.
    """
    payload = [c for c in history.columns if c not in keys]
    clash = set(payload) & set(facts.columns)
    if clash:
        raise ValueError(f"columns in both inputs: {sorted(clash)}")
    usable = reduce(Column.__and__, (F.col(k).isNotNull() for k in [*keys, at]))
    known = history.filter(reduce(Column.__and__, (F.col(k).isNotNull() for k in [*keys, START])))
    key_types = {k: t for k, t in history.dtypes if k in keys}
    code = key_code(keys)
    (many,) = heavy_counts(known, code, min_rows=FEW_VERSIONS)
    typed = facts.filter(usable).withColumns({k: F.col(k).cast(key_types[k]) for k in keys})
    found = _met(typed.filter(~is_any(code, list(many))), known.filter(~is_any(code, list(many))), keys, at, payload)
    if many:
        found = found.unionByName(_lined_up(typed.filter(is_any(code, list(many))), known.filter(is_any(code, list(many))), keys, at, payload))
    # Facts without a key or time match nothing and need no shuffle.
    unmatched = facts.filter(~usable).withColumns({k: F.col(k).cast(key_types[k]) for k in keys}).select(
        "*", *(F.lit(None).cast(dtype).alias(c) for c, dtype in history.select(*payload).dtypes)
    )
    return found.unionByName(unmatched)


def _met(facts: DataFrame, known: DataFrame, keys: Sequence[str], at: str, payload: Sequence[str]) -> DataFrame:
    """Facts joined with the few versions of their key."""
    code = key_code(keys)
    left, right = sliced(facts.withColumn("_code", code), known.withColumn("_code", code), "_code", "_slice")
    right = right.select(*(F.col(c).alias(f"_v_{c}") for c in [*keys, "_slice", *payload]))
    time, end = F.col(at).cast("timestamp"), F.col(f"_v_{END}").cast("timestamp")
    match = reduce(Column.__and__, (F.col(c) == F.col(f"_v_{c}") for c in [*keys, "_slice"]))
    inside = (F.col(f"_v_{START}").cast("timestamp") <= time) & (end.isNull() | (time < end))
    met = left.join(right, match & inside, "left")
    return met.select(*facts.columns, *(F.col(f"_v_{c}").alias(c) for c in payload))


def _lined_up(facts: DataFrame, known: DataFrame, keys: Sequence[str], at: str, payload: Sequence[str]) -> DataFrame:
    """Facts and versions of keys with many versions, sorted by time together."""
    fact_type, version_type = facts.schema.simpleString(), known.select(*payload).schema.simpleString()
    events = facts.select(
        *keys,
        F.col(at).cast("timestamp").alias("_at"),
        F.lit(1).alias("_kind"),
        F.struct(*(F.col(c) for c in facts.columns)).alias("_fact"),
        F.lit(None).cast(version_type).alias("_version"),
    )
    versions = known.select(
        *keys,
        F.col(START).cast("timestamp").alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(fact_type).alias("_fact"),
        F.struct(*payload).alias("_version"),
    )
    lined_up = events.unionByName(versions)
    usual, heavy = _split(lined_up, keys)
    w = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = usual.withColumn("_valid", F.last("_version", ignorenulls=True).over(w))
    if heavy is not None:
        ranged = _ranged(heavy, keys, "_at", cut_points(heavy, keys, "_at", _pieces(heavy)))
        earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        carried = _from_neighbour(
            ranged,
            keys,
            F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_at"))),
            lambda edge: F.last(edge, ignorenulls=True).over(earlier),
        )
        inside = Window.partitionBy(*keys, "_range").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
        valid = F.coalesce(F.last("_version", ignorenulls=True).over(inside), F.col("_carry"))
        seen = seen.unionByName(carried.withColumn("_valid", valid).drop("_range", "_carry"))

    end = F.col(f"_valid.{END}").cast("timestamp")
    in_force = F.when(end.isNull() | (F.col("_at") < end), F.col("_valid"))
    found = seen.filter(F.col("_kind") == 1).select("_fact.*", in_force.alias("_valid"))
    return found.select(*facts.columns, *(F.col(f"_valid.{c}").alias(c) for c in payload))
