"""Where the lake's tables are stored, and how they are read, written and compacted."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shoplake.config import FULL_LOAD, STORED, contract_ddl, full_load_path
from shoplake.functions.shape import quoted
from shoplake.functions.types import STATE, merged, states, type_of
from shoplake.operators.quality import apply
from shoplake.operators.skew import heavy_keys
from shoplake.plans.medallion import BUCKETED, TABLES, Table, make, upserted
from shoplake.session import glob, remove, shuffles_dropped
from shoplake.sources import csv

#: Tables that are written at the same time.
SIDE_BY_SIDE = 4
#: Bytes of inputs for each core from which on a table fills all cores by itself. Such tables are made one at a time, so their shuffles
#: never lie on the disks together.
ALONE_FROM = 128 << 20


def _bytes(df: DataFrame) -> int:
    """Size of a frame's files, as Spark estimates it for its plans."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


@dataclass(frozen=True)
class Lake:
    """A root folder on storage that the driver and all executors reach.

    Bucketed tables also need a catalog ``database``, because bucketing is known to the catalog only.
    """

    spark: SparkSession
    root: str
    database: str | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def has(self, path: str) -> bool:
        try:
            self.spark.read.schema("marker int").parquet(path)
            return True
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise

    # --- bronze -----------------------------------------------------------------------------------------------------
    def note_extra(self, entity: str, load: str, names: Sequence[str], landed: str) -> None:
        """Remember the columns of a load that are outside the contract, and the state of their types, so that readers need not open
        any file for them. Only those columns of the landed rows are read."""
        if not names:
            return
        schema = ", ".join(f"{quoted(n)} string" for n in names)
        # Columns are read under plain names, as their own may hold dots.
        plain = [f"_c{k}" for k in range(len(names))]
        rows = self.spark.read.schema(schema).parquet(landed).toDF(*plain).agg(F.explode(states(plain)).alias("x"))
        named = F.element_at(F.create_map(*(F.lit(x) for pair in zip(plain, names, strict=True) for x in pair)), F.col("x.column_name"))
        rows.select(named.alias("column_name"), "x.state.*").coalesce(1).write.mode("overwrite").parquet(self.path("bronze", entity, "columns", load))

    def column_types(self, entity: str) -> dict[str, str]:
        """Columns outside the contract, by the types that all loads so far agree on. Types widen as loads come, and never narrow."""
        path = self.path("bronze", entity, "columns")
        if not self.has(path):
            return {}
        noted = self.spark.read.schema(f"column_name string, {STATE}").option("recursiveFileLookup", "true").parquet(path)
        # Names that differ in case only are one column, as elsewhere in Spark.
        first = noted.groupBy(F.lower("column_name").alias("n")).agg(F.min("column_name").alias("column_name"), *merged())
        return {r["column_name"]: type_of(r.asDict()) for r in sorted(first.collect(), key=lambda r: r["column_name"])}

    def extra_columns(self, entity: str) -> list[str]:
        return list(self.column_types(entity))

    def bronze_schema(self, entity: str) -> str:
        return ", ".join([contract_ddl(entity), *(f"{quoted(c)} string" for c in self.extra_columns(entity))])

    def inferred(self, entity: str) -> DataFrame:
        """``bronze``, with the columns outside the contract in the types found for them. They are stored as text, so rows of earlier
        loads are read in a type that was widened since."""
        types = {name.lower(): kind for name, kind in self.column_types(entity).items()}
        rows = self.bronze(entity)
        return rows.selectExpr(*(f"try_cast(trim({quoted(c)}) AS {types[c.lower()]}) AS {quoted(c)}" if types.get(c.lower(), "string") != "string" else quoted(c) for c in rows.columns))

    def rescued(self, entity: str) -> DataFrame:
        """Per load and source file, the rows that held something their types or header had no place for."""
        found = self.bronze(entity).filter("_rescued IS NOT NULL")
        return found.groupBy("_load_type", "_source_file").agg(F.count(F.lit(1)).alias("rescued_rows"))

    def backfill(self, entity: str, base: str) -> bool:
        """Load the entity's full CSV file (or folder) once; later calls do nothing.

        It has a folder of its own: readers of a folder that a stream also writes would miss these rows. The mark is
        written last, so an interrupted load is repeated from the start.
        """
        target, mark = self.path("bronze", entity, "full"), self.path("bronze", entity, "full_loaded")
        if self.has(mark):
            return False
        source = full_load_path(base, entity)
        if not csv.any_files(self.spark, source):
            return False
        extra = csv.land(self.spark, source, entity, FULL_LOAD, lambda df: df.write.mode("overwrite").options(**STORED).parquet(target))
        self.note_extra(entity, "full", extra, target)
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(mark)
        return True

    def _manifest(self, entity: str) -> tuple[int, int]:
        """Number of the newest complete compaction of an entity's batches, and the last batch in it (-1 where there is none)."""
        marks = self.path("bronze", entity, "compacted")
        if not self.has(marks):
            return -1, -1
        found = self.spark.read.schema("version int, last_batch int").option("recursiveFileLookup", "true").parquet(marks)
        newest = found.orderBy(F.col("version").desc()).first()
        return newest["version"], newest["last_batch"]

    def _batches(self, entity: str, schema: str, after: int, upto: int | None = None) -> DataFrame | None:
        path = self.path("bronze", entity, "incremental")
        if not self.has(path):
            return None
        # The number is a folder name, so batches outside are not opened.
        kept = F.col("batch_id") > after if upto is None else F.col("batch_id").between(after + 1, upto)
        return self.spark.read.schema(f"{schema}, batch_id int").parquet(path).filter(kept).drop("batch_id")

    def _incremental(self, entity: str, schema: str, upto: int | None = None) -> list[DataFrame]:
        """The newest compaction and the batches that came since, those up to one or all."""
        version, last = self._manifest(entity)
        later = self._batches(entity, schema, last, upto)
        base = self.spark.read.schema(schema).parquet(self.path("bronze", entity, "base", f"version={version}")) if version >= 0 else None
        return [part for part in (base, later) if part is not None]

    def bronze(self, entity: str) -> DataFrame:
        """Backfilled and incremental rows of an entity as one table; empty if nothing arrived yet."""
        schema = self.bronze_schema(entity)
        full = self.path("bronze", entity, "full")
        parts = [self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(full)] if self.has(full) else []
        parts += self._incremental(entity, schema)
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def compact_bronze(self, entity: str) -> bool:
        """Fold an entity's many small batches into files of even size that ``bronze`` reads in their place.

        The manifest names the folded files and the last batch in them, and is written last: an interrupted compaction changes
        nothing, and a batch that arrives meanwhile has a higher number and is read beside them. Batch folders stay, for
        the streams that read them.
        """
        path = self.path("bronze", entity, "incremental")
        if not self.has(path):
            return False
        version, last = self._manifest(entity)
        newest = self.spark.read.schema("batch_id int, _load_type string").parquet(path).agg(F.max("batch_id")).first()[0]
        if newest is None or newest <= last:
            return False
        rows = reduce(DataFrame.unionByName, self._incremental(entity, self.bronze_schema(entity), upto=newest))
        rows.hint("rebalance").write.mode("overwrite").options(**STORED).parquet(self.path("bronze", entity, "base", f"version={version + 1}"))
        mark = self.spark.createDataFrame([(version + 1, newest)], "version int, last_batch int").coalesce(1)
        mark.write.mode("overwrite").parquet(self.path("bronze", entity, "compacted", f"version={version + 1}"))
        return True

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove versions of stored tables, compactions, snapshots and histories but the newest ``keep``; returns what was removed.

        Marks stay, and so does a version without a mark, which a running job may be writing. A reader that began on a removed
        version fails, so keep as many as there are refreshes while the longest query runs.
        """
        groups = [("tables", "*", "version=*", "done"), ("bronze", "*", "base/version=*", "compacted")]
        groups += [(kind, "*", "base/version=*", "done") for kind in ("current", "history")]
        removed = []
        for top, name, versions, marks in groups:
            found: dict[str, list[tuple[int, str]]] = {}
            done = set(glob(self.spark, self.path(top, name, marks, "version=*")))
            for folder in glob(self.spark, self.path(top, name, versions)):
                owner, number = folder.rsplit("/version=", 1)
                if f"{owner.removesuffix('/base')}/{marks}/version={number}" in done:
                    found.setdefault(owner, []).append((int(number), folder))
            for numbered in found.values():
                removed += [folder for _, folder in sorted(numbered)[: max(0, len(numbered) - max(keep, 1))]]
        for folder in removed:
            remove(self.spark, folder)
        return removed

    # --- derived tables ---------------------------------------------------------------------------------------------
    def _is_bucketed(self, name: str) -> bool:
        return bool(self.database) and self.spark.catalog.tableExists(f"{self.database}.{name}")

    def version(self, name: str) -> int:
        """Number of a table's newest complete version; -1 where there is none."""
        marks = self.path("tables", name, "done")
        if not self.has(marks):
            return -1
        found = self.spark.read.schema("version int").option("recursiveFileLookup", "true").parquet(marks)
        newest = found.agg(F.max("version")).first()[0]
        return -1 if newest is None else newest

    def table(self, name: str) -> DataFrame:
        if self._is_bucketed(name):
            return self.spark.table(f"{self.database}.{name}")
        version = self.version(name)
        if version < 0:
            raise ValueError(f"table {name} is not stored yet")
        return self.spark.read.parquet(self.path("tables", name, f"version={version}"))

    def _store(self, name: str, made: DataFrame, buckets: int) -> None:
        """Write a new version beside the old one. Readers move on once its mark, written last, is there.

        A job that fails leaves the old version as it was. A bucketed version is a table of its own in the catalog, and the
        table's name a view of the newest.
        """
        version = self.version(name) + 1
        path = self.path("tables", name, f"version={version}")
        bucketed = bool(self.database and name in BUCKETED and buckets and not heavy_keys(made, "order_id")[0])
        if bucketed:
            entry = f"{self.database}.{name}__{version}"
            # An external table: only what a failed attempt left in the catalog goes.
            self.spark.sql(f"DROP TABLE IF EXISTS {entry}")
            laid_out = made.repartition(buckets, "order_id").write.mode("overwrite").options(**STORED).bucketBy(buckets, "order_id")
            laid_out.sortBy("order_id").option("path", path).saveAsTable(entry, format="parquet")
        else:
            made.write.mode("overwrite").options(**STORED).parquet(path)
        mark = self.spark.createDataFrame([(version,)], "version int").coalesce(1)
        mark.write.mode("overwrite").parquet(self.path("tables", name, "done", f"version={version}"))
        if bucketed:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS SELECT * FROM {entry}")
        elif self.database and self._is_bucketed(name):
            self.spark.sql(f"DROP VIEW {self.database}.{name}")

    def materialize(
        self,
        names: Iterable[str] = TABLES,
        as_of: dt.date | None = None,
        upsert: bool = False,
        buckets: int = 0,
        expectations: Mapping[str, Mapping[str, str | tuple[str, str]]] | None = None,
    ) -> dict[str, dict[str, int]]:
        """Recompute and store tables, each from its stored inputs, so that no work is done twice. Tables that do not need each
        other are made side by side, but for large ones. Their shuffle files go as each is stored.

        ``expectations`` names rules per table. Rows that break one are counted while the table is written, without a pass of
        their own; the counts are returned per table, with the row count as ``_rows``. A rule may come with an action: ``drop``
        leaves such rows out of the table, ``fail`` keeps the old version of it and raises.

        With ``buckets`` the silver tables that join by order are laid out by order as they are written, in place of a
        shuffle in each of the three facts that read them. A table with a heavy order id is not bucketed: one
        bucket would hold its rows.
        """
        wanted, counts, alone = set(names), {}, Lock()
        large = ALONE_FROM * self.spark.sparkContext.defaultParallelism

        def run(name: str, table: Table, before: list[Future]) -> None:
            for stored in before:
                stored.result()
            inputs = []
            for source in table.inputs:
                if source.endswith("_bronze"):
                    entity = source.removesuffix("_bronze")
                    inputs.append(upserted(entity, self.bronze(entity)) if upsert else self.bronze(entity))
                else:
                    inputs.append(self.table(source))
            laid_out = all(self._is_bucketed(source) for source in table.inputs)
            rules = (expectations or {}).get(name)
            with alone if sum(map(_bytes, inputs)) >= large else nullcontext():
                made = make(name, inputs, as_of, laid_out)
                if rules:
                    made, seen = apply(made, rules, name)
                self._store(name, made, buckets)
            if rules:
                counts[name] = seen.get

        # A table is handed in after its inputs, so what a worker waits for has always been begun.
        with shuffles_dropped(self.spark), ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            jobs: dict[str, Future] = {}
            for name, table in TABLES.items():
                if name in wanted:
                    jobs[name] = pool.submit(run, name, table, [jobs[i] for i in table.inputs if i in jobs])
        for job in jobs.values():
            job.result()
        return counts


def compact(spark: SparkSession, source: str, target: str, *by: str) -> None:
    """Rewrite a folder of small files as files of even size, optionally laid out by columns.

    The rebalance hint lets Spark choose the number of files from the measured size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and split those that one frequent value would blow up.
    """
    rows = spark.read.option("mergeSchema", "true").parquet(source)
    rows.hint("rebalance", *(F.col(c) for c in by)).write.mode("overwrite").parquet(target)
