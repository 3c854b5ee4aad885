"""Pick one row per key, with an order that never leaves a tie to chance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.config import FULL_LOAD

INGESTED = "_ingestion_timestamp"
CHANGED = "_changed_at"
LOADED = "_load_type"
PLACE = ("_source_file", "_source_block", "_source_row")


def change_time(columns: Sequence[str], ts: str = INGESTED) -> Column:
    """When a row's source was written, or loaded where that is not known."""
    return F.coalesce(CHANGED, ts) if ts == INGESTED and CHANGED in columns else F.col(ts)


def precedence() -> Column:
    """Rank of a row's kind of load: a backfill holds what was there before any increment, whenever it is written or loaded."""
    return F.when(F.col(LOADED) == FULL_LOAD, 0).otherwise(1)


def _source_order(columns: Sequence[str], ts: str) -> list[Column]:
    """Load time and place in the source. Files are ordered by name, shorter ones first, so that a counter need not be padded."""
    lead = [F.col(c) for c in (ts, INGESTED) if c in columns]
    for name in (c for c in PLACE if c in columns):
        lead += [F.length(name)] * (name == "_source_file") + [F.col(name)]
    return lead


def _rest(columns: Sequence[str], ts: str) -> list[Column]:
    return [F.col(c) for c in columns if c not in {ts, INGESTED, *PLACE}]


def load_order(columns: Sequence[str], ts: str = INGESTED) -> list[Column]:
    """What is known about when a row changed: kind of load, change time, load time, place in the source.

    The kind of load comes first, so no file time lets a backfill that is copied or loaded late beat an increment; load time and
    place decide between increments whose files have one time.
    """
    kind = [precedence()] if LOADED in columns else []
    return [*kind, change_time(columns, ts), *_source_order(columns, ts)]


def change_order(columns: Sequence[str], ts: str = INGESTED) -> list[Column]:
    """What tells later changes from earlier ones: ``load_order``, then every other column."""
    return load_order(columns, ts) + _rest(columns, ts)


def time_order(columns: Sequence[str], ts: str = INGESTED) -> list[Column]:
    """``change_order`` along time: at one instant an increment follows a backfill."""
    kind = [precedence()] if LOADED in columns else []
    return [change_time(columns, ts), *kind, *_source_order(columns, ts), *_rest(columns, ts)]


def newest_first(columns: Sequence[str], ts: str = INGESTED) -> list[Column]:
    """``change_order``, all descending with NULLs last."""
    return [c.desc_nulls_last() for c in change_order(columns, ts)]


def keep_latest(df: DataFrame, keys: Sequence[str], ts: str = INGESTED) -> DataFrame:
    """The newest row of each key. Spark prunes to one row per key and task before it shuffles."""
    order = newest_first([c for c in df.columns if c not in keys], ts)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_latest_known(df: DataFrame, keys: Sequence[str], ts: str = INGESTED) -> DataFrame:
    """The newest row of each complete key. Rows without one cannot be matched and are all kept."""
    complete = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    return keep_latest(df.filter(complete), keys, ts).unionByName(df.filter(~complete))


def newest(*columns: str, of: Sequence[str], ts: str = INGESTED) -> Column:
    """Aggregate: the named columns, as a struct, of the group's newest row in ``load_order``; ``of`` are the frame's columns. Rows that
    nothing else tells apart are ordered by the values themselves."""
    order = [c.alias(f"_order{k}") for k, c in enumerate(load_order(of, ts))]
    return F.max(F.struct(*order, *columns))
