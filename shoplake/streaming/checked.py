"""Expectations on a stream: rows that break a rule are kept apart.

Rules have an action: ``warn`` only counts, ``drop`` puts a row into quarantine, ``fail`` stops the stream before the batch counts. A row's broken
rules are a bit mask, one bit for each rule in the order of the rules. One pass writes rows of both kinds and counts.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.operators.quality import ACTIONS, DROP, FAIL, ExpectationError, broken_mask, observe
from shoplake.sources.lake import Lake
from shoplake.streaming.flows import _finish, _start, _stream_folder

MASK, CLEAN = "_broken", "_clean"

#: A rule's predicate as SQL text, and what happens to rows that break it.
Rules = Mapping[str, tuple[str, str]]


def _path(lake: Lake, entity: str, *parts: str) -> str:
    return lake.path("checked", entity, *parts)


def _bits(rules: Rules, action: str) -> int:
    return sum(1 << k for k, (_, does) in enumerate(rules.values()) if does == action)


def check_stream(lake: Lake, entity: str, rules: Rules) -> None:
    """Carry new bronze rows into the entity's checked table or its quarantine.

    A batch always writes the same folders, and its counts last; rows of a batch without counts are not read. So repeating a batch
    after a failure changes nothing, and a batch that breaks a ``fail`` rule leaves no rows behind.
    """
    unknown = {does for _, does in rules.values()} - set(ACTIONS)
    if unknown or len(rules) > 62:
        raise ValueError(f"unknown actions {sorted(unknown)}" if unknown else "a mask holds 62 rules")
    source = lake.path("bronze", entity, "incremental")
    if not lake.has(source):
        return

    def batch(rows: DataFrame, number: int) -> None:
        plain = {name: sql for name, (sql, _) in rules.items()}
        seen, counts = observe(rows, plain, f"{entity}-{number}")
        masked = seen.withColumn(MASK, broken_mask(plain))
        dropped = F.col(MASK).bitwiseAND(F.lit(_bits(rules, DROP))) != 0
        masked.withColumn(CLEAN, ~dropped).write.mode("overwrite").partitionBy(CLEAN).parquet(_path(lake, entity, "rows", f"batch_id={number}"))
        found = counts.get
        failed = {name: found[name] for name, (_, does) in rules.items() if does == FAIL and found[name]}
        if failed:
            raise ExpectationError(failed)
        lines = [(name, does, found["_rows"], found[name]) for name, (_, does) in rules.items()]
        made = lake.spark.createDataFrame(lines, "expectation string, action string, total_rows long, failed_rows long").coalesce(1)
        made.write.mode("overwrite").parquet(_path(lake, entity, "counts", f"batch_id={number}"))

    _finish([_start(_stream_folder(lake, entity, source), lake.path("checkpoints", entity, "checked"), batch, f"{entity}_checked")])


def _rows(lake: Lake, entity: str, clean: bool) -> DataFrame:
    schema = f"{lake.bronze_schema(entity)}, {MASK} long, batch_id int, {CLEAN} boolean"
    if not lake.has(_path(lake, entity, "counts")):
        return lake.spark.createDataFrame([], schema).drop(CLEAN)
    whole = expectation_counts(lake, entity).select("batch_id").distinct()
    found = lake.spark.read.schema(schema).parquet(_path(lake, entity, "rows")).filter(F.col(CLEAN) == clean)
    return found.join(whole, "batch_id", "left_semi").drop(CLEAN)


def clean_rows(lake: Lake, entity: str) -> DataFrame:
    """Rows that break no ``drop`` rule; the mask says what else they break."""
    return _rows(lake, entity, True)


def quarantine(lake: Lake, entity: str, rules: Rules) -> DataFrame:
    """Rows that were held back, with the names of all rules they break."""
    names: list[Column] = [F.when(F.col(MASK).bitwiseAND(F.lit(1 << k)) != 0, F.lit(name)) for k, name in enumerate(rules)]
    return _rows(lake, entity, False).withColumn("broken_rules", F.array_compact(F.array(*names)))


def expectation_counts(lake: Lake, entity: str) -> DataFrame:
    """Rows seen and failed by batch and rule."""
    schema = "expectation string, action string, total_rows long, failed_rows long, batch_id int"
    path = _path(lake, entity, "counts")
    return lake.spark.read.schema(schema).parquet(path) if lake.has(path) else lake.spark.createDataFrame([], schema)


def mask_of(rules: Rules, names: list[str]) -> int:
    """The mask of some rules."""
    return reduce(int.__or__, (1 << list(rules).index(n) for n in names), 0)
