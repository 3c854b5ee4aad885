"""Incremental flows: files to staging, staging to bronze, bronze to current state.

Every flow is one query with ``availableNow``: it takes what is there, records its progress in a checkpoint and stops.
A batch always writes the same folder, named by its number, so repeating it after a failure replaces the
first attempt. A flow that reads another's output is started only after that one has ended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoplake.config import INCREMENT, INCREMENTAL, KEYS, STORED, staging_path
from shoplake.operators.dedup import keep_latest_known
from shoplake.sources import csv
from shoplake.sources.lake import Lake

FILES_PER_BATCH = 1000

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _start(rows: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], name: str) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName(name)
        .start()
    )


def _finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for all queries, then raise the first failure, if any."""
    failures = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            failures.append(error)
    if failures:
        raise failures[0]


def start_staging(lake: Lake, entity: str, landing: str, files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """New CSV files of an entity to its staging table. The stream only carries file names; each batch reads its files by header."""
    spark = lake.spark
    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(staging_path(landing, entity))
        .filter(F.col("length") > 0)
        .select("path")
    )

    def batch(found: DataFrame, number: int) -> None:
        # At most files_per_batch names.
        files = [row["path"] for row in found.collect()]
        if not files:
            return
        target = lake.path("staging", entity, f"batch_id={number}")
        extra = csv.land(spark, files, entity, INCREMENT, lambda df: df.write.mode("overwrite").options(**STORED).parquet(target))
        lake.note_extra(entity, f"batch_id={number}", extra, target)

    return _start(names, lake.path("checkpoints", entity, "staging"), batch, f"{entity}_staging")


def _stream_folder(lake: Lake, entity: str, path: str) -> DataFrame:
    return lake.spark.readStream.schema(lake.bronze_schema(entity)).option("recursiveFileLookup", "true").parquet(path)


def start_append(lake: Lake, entity: str) -> StreamingQuery:
    """New staging rows of an entity to its bronze table."""

    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").options(**STORED).parquet(lake.path("bronze", entity, "incremental", f"batch_id={number}"))

    source = _stream_folder(lake, entity, lake.path("staging", entity))
    return _start(source, lake.path("checkpoints", entity, "append"), batch, f"{entity}_append")


def ingest(lake: Lake, landing: str, entities: Iterable[str] = INCREMENTAL, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Take in all files that arrived since the last call. Entities without a landing folder are skipped."""
    present = [e for e in entities if csv.any_files(lake.spark, staging_path(landing, e))]
    _finish([start_staging(lake, e, landing, files_per_batch) for e in present])
    _finish([start_append(lake, e) for e in present if lake.has(lake.path("staging", e))])


# --- current state (upsert) -----------------------------------------------------------------------------------------
def upsert(lake: Lake, entity: str) -> None:
    """Carry new bronze rows into the entity's current-state table.

    A batch stores only its own newest rows per key; ``current`` merges on read. Rewriting the whole table for each
    batch would cost its full size every time; ``compact_current`` does that when it pays.
    """
    source = lake.path("bronze", entity, "incremental")
    if not lake.has(source):
        return

    def batch(rows: DataFrame, number: int) -> None:
        target = lake.path("current", entity, "changes", f"batch_id={number}")
        keep_latest_known(rows, KEYS[entity]).write.mode("overwrite").parquet(target)

    query = _start(_stream_folder(lake, entity, source), lake.path("checkpoints", entity, "upsert"), batch, f"{entity}_upsert")
    _finish([query])


def _snapshot(lake: Lake, entity: str) -> tuple[int, int, bool]:
    """Number of the newest complete snapshot, the last batch in it (-1 where there is none), and whether it has the backfill."""
    marks = lake.path("current", entity, "done")
    if not lake.has(marks):
        return -1, -1, False
    found = lake.spark.read.schema("version int, last_batch int, backfilled boolean").option("recursiveFileLookup", "true").parquet(marks)
    newest = found.orderBy(F.col("version").desc()).first()
    return newest["version"], newest["last_batch"], bool(newest["backfilled"])


def _backfilled(lake: Lake, entity: str) -> bool:
    """Whether a complete backfill is there; its mark is written last."""
    return lake.has(lake.path("bronze", entity, "full_loaded"))


def _last_batch(lake: Lake, entity: str, since: int) -> int:
    """Number of the newest batch of changes."""
    changes = lake.path("current", entity, "changes")
    if not lake.has(changes):
        return since
    # The batch number is a folder name, so this reads no data.
    newest = lake.spark.read.schema("batch_id int, _load_type string").parquet(changes).agg(F.max("batch_id")).first()[0]
    return since if newest is None else max(newest, since)


def _merged(lake: Lake, entity: str, snapshot: tuple[int, int, bool], upto: int, backfilled: bool) -> DataFrame:
    """A snapshot with the changes up to a batch, and with the backfill if that came since."""
    version, last_batch, with_full = snapshot
    schema = lake.bronze_schema(entity)
    parts = []
    if version >= 0:
        parts.append(lake.spark.read.schema(schema).parquet(lake.path("current", entity, "base", f"version={version}")))
    if backfilled and not with_full:
        parts.append(lake.spark.read.schema(schema).parquet(lake.path("bronze", entity, "full")))
    if upto > last_batch:
        later = lake.spark.read.schema(f"{schema}, batch_id int").parquet(lake.path("current", entity, "changes"))
        parts.append(later.filter(F.col("batch_id").between(last_batch + 1, upto)).drop("batch_id"))
    if not parts:
        return lake.spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def _current(lake: Lake, entity: str) -> tuple[DataFrame, tuple[int, int, bool]]:
    """The current state, and what it was made of: version of the snapshot, last batch, whether the backfill is in it."""
    snapshot, backfilled = _snapshot(lake, entity), _backfilled(lake, entity)
    upto = _last_batch(lake, entity, snapshot[1])
    rows = keep_latest_known(_merged(lake, entity, snapshot, upto, backfilled), KEYS[entity])
    return rows, (snapshot[0], upto, backfilled or snapshot[2])


def current(lake: Lake, entity: str) -> DataFrame:
    """One row per key: the newest of the last snapshot and what came since. Rows without a complete key all stay."""
    return _current(lake, entity)[0]


def compact_current(lake: Lake, entity: str) -> None:
    """Fold the changes into a new snapshot. Readers move on once its mark, written last, is there. The mark names what was read, so
    a batch or backfill that lands meanwhile is taken in after it."""
    rows, (version, last_batch, backfilled) = _current(lake, entity)
    version += 1
    rows.write.mode("overwrite").parquet(lake.path("current", entity, "base", f"version={version}"))
    mark = lake.spark.createDataFrame([(version, last_batch, backfilled)], "version int, last_batch int, backfilled boolean").coalesce(1)
    mark.write.mode("overwrite").parquet(lake.path("current", entity, "done", f"version={version}"))
