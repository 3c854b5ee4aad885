"""Version histories that are kept up batch by batch.

A batch writes only the rows it alters, as a generation of its own; of the rows of one key and time the newest generation counts. A
compaction folds the generations into a base that is sorted by key, so that later batches read the key range they touch. A batch
reads the generations before its own and always writes the same folder, so repeating it after a failure changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.config import KEYS, contract_ddl
from shoplake.functions.shape import conform
from shoplake.operators.dedup import CHANGED
from shoplake.operators.history import END, GONE, SHOWN, START, maintain, versions
from shoplake.sources.lake import Lake
from shoplake.streaming.flows import _backfilled, _finish, _start, _stream_folder

_MARKS = f"`{START}` timestamp, `{END}` timestamp, `{SHOWN}` boolean"


def _path(lake: Lake, entity: str, *parts: str) -> str:
    return lake.path("history", entity, *parts)


def _base(lake: Lake, entity: str) -> tuple[int, int]:
    """Number of the newest complete base, and the last generation in it (-1 where there is none)."""
    marks = _path(lake, entity, "done")
    if not lake.has(marks):
        return -1, -1
    found = lake.spark.read.schema("version int, generation long").option("recursiveFileLookup", "true").parquet(marks)
    newest = found.orderBy(F.col("version").desc()).first()
    return newest["version"], newest["generation"]


def _generations(lake: Lake, entity: str) -> DataFrame | None:
    folder = _path(lake, entity, "changes")
    if not lake.has(folder):
        return None
    return lake.spark.read.schema(f"{contract_ddl(entity)}, {_MARKS}, `{GONE}` boolean, generation long").parquet(folder)


def _last_generation(lake: Lake, entity: str) -> int:
    found = _generations(lake, entity)
    # The number is a folder name, so this reads no data.
    newest = None if found is None else found.agg(F.max("generation")).first()[0]
    return _base(lake, entity)[1] if newest is None else newest


def _in_range(changes: DataFrame, key: str) -> Column:
    """A filter on stored rows that reaches their files' statistics: the range of a batch's keys, two values."""
    lo, hi = changes.agg(F.min(key), F.max(key)).first()
    return F.col(key).isNull() | (F.lit(False) if lo is None else F.col(key).between(lo, hi))


def stored_history(lake: Lake, entity: str, below: int | None = None, changes: DataFrame | None = None) -> DataFrame:
    """The rows that count, of all generations or those before one; with ``changes`` only those in the range of its keys."""
    identity = [*KEYS[entity], CHANGED]
    version, last = _base(lake, entity)
    wanted = F.lit(True) if changes is None else _in_range(changes, KEYS[entity][0])
    schema = f"{contract_ddl(entity)}, {_MARKS}"
    base = lake.spark.read.schema(schema).parquet(_path(lake, entity, "base", f"version={version}")) if version >= 0 else lake.spark.createDataFrame([], schema)
    base, later = base.filter(wanted), _generations(lake, entity)
    if later is None:
        return base
    later = later.filter((F.col("generation") > last) & (F.lit(True) if below is None else F.col("generation") < below)).filter(wanted)
    # One generation alters a key and time at most once.
    newest = later.groupBy(*identity).agg(F.max_by(F.struct(*(c for c in later.columns if c not in identity)), "generation").alias("_row")).select(*identity, "_row.*")
    match = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in identity))
    replaced = newest.select(*(F.col(c).alias(f"_n_{c}") for c in identity))
    kept = base.join(replaced, match, "left_anti")
    return kept.unionByName(newest.filter(~F.col(GONE)).drop(GONE, "generation").select(*base.columns))


def _put(lake: Lake, entity: str, rows: DataFrame, generation: int) -> None:
    changes = conform(rows, entity)
    stored = stored_history(lake, entity, generation, changes)
    altered = maintain(stored, changes, KEYS[entity])
    altered.write.mode("overwrite").parquet(_path(lake, entity, "changes", f"generation={generation}"))


def maintain_history(lake: Lake, entity: str) -> None:
    """Carry what bronze has gained since the last call, backfill included, into the entity's stored history."""
    mark = _path(lake, entity, "backfilled")
    if _backfilled(lake, entity) and not lake.has(mark):
        # Stream batches have odd generations, so this lies between two of them.
        generation = (_last_generation(lake, entity) + 1) // 2 * 2
        _put(lake, entity, lake.spark.read.schema(lake.bronze_schema(entity)).parquet(lake.path("bronze", entity, "full")), generation)
        lake.spark.range(1).coalesce(1).write.mode("overwrite").parquet(mark)
    source = lake.path("bronze", entity, "incremental")
    if lake.has(source):

        def batch(rows: DataFrame, number: int) -> None:
            _put(lake, entity, rows, 2 * number + 1)

        _finish([_start(_stream_folder(lake, entity, source), lake.path("checkpoints", entity, "history"), batch, f"{entity}_history")])


def history(lake: Lake, entity: str) -> DataFrame:
    """The entity's versions, as ``scd2`` of all its bronze rows gives them."""
    return versions(stored_history(lake, entity))


def compact_history(lake: Lake, entity: str) -> None:
    """Fold all generations into a new base, sorted by key. Readers move on once its mark, written last, is there."""
    generation, version = _last_generation(lake, entity), _base(lake, entity)[0] + 1
    order = [*KEYS[entity], CHANGED]
    rows = stored_history(lake, entity, generation + 1).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").parquet(_path(lake, entity, "base", f"version={version}"))
    done = lake.spark.createDataFrame([(version, generation)], "version int, generation long").coalesce(1)
    done.write.mode("overwrite").parquet(_path(lake, entity, "done", f"version={version}"))
